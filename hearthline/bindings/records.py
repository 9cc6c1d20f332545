"""Validation rules, store constraints and error counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.bindings import shapes
from hearthline.bindings.views import ORDER, YEAR, Views, bound, sql
from hearthline.operators import constraints, rules
from hearthline.plans.feeds import ACTIVE, SOLD

_REQUIRED = "Required field"


def _text(column: str) -> str:
    """A whole or halved number as the error report writes it."""
    return (
        f"CASE WHEN {column} = floor({column}) THEN CAST(CAST({column} AS BIGINT) AS VARCHAR) "
        f"ELSE CAST({column} AS VARCHAR) END"
    )


# field -> (column, how its value is written), for listings and for sales.
LISTING = {
    "id": ("id", "CAST(id AS VARCHAR)"),
    "price": ("price", "CAST(price AS VARCHAR)"),
    "rooms": ("rooms", _text("rooms")),
    "size": ("size", "CAST(size AS VARCHAR)"),
    "city": ("city", "city"),
    "zipCode": ("zip_code", "CAST(zip_code AS VARCHAR)"),
    "street": ("street", "street"),
    "buildYear": ("build_year", "CAST(build_year AS VARCHAR)"),
    "latitude": ("latitude", _text("latitude")),
    "longitude": ("longitude", _text("longitude")),
    "daysForSale": ("days_for_sale", "CAST(days_for_sale AS VARCHAR)"),
    "createdDate": ("created_text", "created_text"),
}
SALE = {
    "estateId": ("estate_id", "CAST(estate_id AS VARCHAR)"),
    "address": ("address", "address"),
    "zipCode": ("zip_code", "CAST(zip_code AS VARCHAR)"),
    "price": ("price", "CAST(price AS VARCHAR)"),
    "soldDate": ("sold_text", "sold_text"),
    "city": ("city", "city"),
    "rooms": ("rooms", "CAST(rooms AS VARCHAR)"),
    "size": ("size", "CAST(size AS VARCHAR)"),
    "buildYear": ("build_year", "CAST(build_year AS VARCHAR)"),
    "latitude": ("latitude", "CAST(latitude AS VARCHAR)"),
    "longitude": ("longitude", "CAST(longitude AS VARCHAR)"),
    "sqmPrice": ("sqm_price", "CAST(sqm_price AS VARCHAR)"),
}

# What each rule calls bad, as SQL on the columns. A null price or zip code is
# bad for its range rule too.
_BAD = {
    "price": "(price IS NULL OR price <= 0)",
    "rooms": "rooms < 0",
    "size": "size <= 0",
    "zipCode": "(zip_code IS NULL OR zip_code NOT BETWEEN 1000 AND 9999)",
    "buildYear": f"build_year NOT BETWEEN 1800 AND {YEAR}",
    "latitude": "latitude NOT BETWEEN -90 AND 90",
    "longitude": "longitude NOT BETWEEN -180 AND 180",
    "daysForSale": "days_for_sale < 0",
    "createdDate": "created_text IN ('2024', '2024-02-30')",
    "sqmPrice": "sqm_price < 0",
    "soldDate": "sold_text = '2024-05'",
}

# The rules in report order, as (field, message), written out here so that a
# rule left out of the library shows.
_MISSING = "Required field '{}' is missing or null"
ACTIVE_TOLD = [
    *((f, _MISSING.format(f)) for f in ("id", "price", "rooms", "size", "city", "zipCode", "street")),
    ("price", "Price must be a positive number"),
    ("rooms", "Rooms must be a non-negative number"),
    ("size", "Size must be a positive number"),
    ("zipCode", "zipCode must be a 4-digit number between 1000-9999"),
    ("buildYear", f"buildYear must be between 1800 and {YEAR}"),
    ("latitude", "latitude must be between -90 and 90"),
    ("longitude", "longitude must be between -180 and 180"),
    ("daysForSale", "daysForSale must be a non-negative number"),
    ("createdDate", "Invalid date format"),
]
SOLD_TOLD = [
    *((f, _MISSING.format(f)) for f in ("estateId", "address", "zipCode", "price", "soldDate", "city")),
    ("price", "Price must be a positive number"),
    ("rooms", "Rooms must be a non-negative number"),
    ("size", "Size must be a positive number"),
    ("zipCode", "zipCode must be a 4-digit number between 1000-9999"),
    ("buildYear", f"buildYear must be between 1800 and {YEAR}"),
    ("latitude", "latitude must be between -90 and 90"),
    ("longitude", "longitude must be between -180 and 180"),
    ("sqmPrice", "sqmPrice must be a non-negative number"),
    ("soldDate", "Invalid date format"),
]

LISTING_KEY = ("id", *ORDER)
SALE_KEY = ("sale",)


def _pairs(told: list[tuple[str, str]], fields: dict[str, tuple[str, str]]) -> list[tuple[str, str, str, str]]:
    """(field, value text, bad condition, message) of each rule."""
    out = []
    for field, message in told:
        column, value = fields[field]
        bad = f"{column} IS NULL" if message.startswith(_REQUIRED) else _BAD[field]
        out.append((field, value, bad, message))
    return out


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _errors_sql(view: str, key: str, pairs) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, {_quoted(field)} AS field, {value} AS value, {_quoted(message)} AS message "
        f"FROM {view} WHERE {bad}"
        for field, value, bad, message in pairs
    )


def _chosen(field: str | None, sold: bool):
    every = rules.sold_rules(YEAR) if sold else rules.active_rules(YEAR)
    return [r for r in every if _is_chosen(r.field, r.message, field)]


def _is_chosen(of: str, message: str, field: str | None) -> bool:
    required = message.startswith(_REQUIRED)
    return required if field is None else of == field and not required


def _rule(field: str | None, sold: bool = False):
    """The errors one rule (or the required fields) finds, record by record."""
    chosen = _chosen(field, sold)

    def run(view: Views) -> DataFrame:
        if sold:
            items, key = shapes.sale_items(view), SALE_KEY
        else:
            items, key = shapes.listing_items(view), LISTING_KEY
        return rules.errors_exploded(rules.validate(items, chosen), *key)

    told = [t for t in (SOLD_TOLD if sold else ACTIVE_TOLD) if _is_chosen(*t, field)]
    if sold:
        text = sql(_errors_sql("v_sale", "estate_id AS sale", _pairs(told, SALE)), "v_sale")
    else:
        text = sql(_errors_sql("v_listing", ", ".join(LISTING_KEY), _pairs(told, LISTING)), "v_listing")
    return bound(run), text


def _count_sql(pairs) -> str:
    return " + ".join(f"CAST(coalesce({bad}, false) AS INT)" for _, _, bad, _ in pairs)


LISTING_ERRORS = _count_sql(_pairs(ACTIVE_TOLD, LISTING))
SALE_ERRORS = _count_sql(_pairs(SOLD_TOLD, SALE))
COUNTED = {"counted": f"SELECT *, {LISTING_ERRORS} AS n_errors FROM v_listing"}
BUDGET = 5


def _checked(view: Views, enabled: bool = True) -> DataFrame:
    return rules.validate(shapes.listing_items(view), rules.active_rules(YEAR), enabled)


def a5(view: Views) -> DataFrame:
    return rules.validation_summary(_checked(view), ["page"])


SUMMARY_SQL = """SELECT {by} count(*) FILTER ({valid}) AS valid_count, count(*) FILTER ({invalid}) AS invalid_count,
    count(*) AS total_count, count(*) FILTER ({valid}) / CAST(count(*) AS DOUBLE) AS success_rate FROM {frame}"""


def a6(view: Views) -> DataFrame:
    return rules.count_errors(shapes.listing_items(view), rules.active_rules(YEAR))


def a6_reported(view: Views) -> DataFrame:
    """The same from the reports of the records."""
    return rules.errors_by_field(_checked(view))


def a6_listing(view: Views) -> DataFrame:
    listed = rules.error_listing(_checked(view))
    return listed.select("page", *LISTING_KEY, F.size("errors").alias("n_errors"))


def _budgeted(view: Views) -> DataFrame:
    items = shapes.listing_items(view)
    checked = rules.validate(items, rules.active_rules(YEAR))
    return rules.error_budget(checked, "page", LISTING_KEY, BUDGET, items)


def n2(view: Views) -> DataFrame:
    spent = _budgeted(view)
    return spent.select("page", *LISTING_KEY, "examined", "is_valid", F.size("errors").alias("n_errors"))


BUDGETED = {
    **COUNTED,
    "budgeted": f"""SELECT *, coalesce(sum(n_errors) OVER (PARTITION BY page ORDER BY id, scraped_at, o1, o2, o3
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < {BUDGET} AS examined FROM counted""",
}


def n2_summary(view: Views) -> DataFrame:
    return rules.validation_summary(_budgeted(view), ["page"])


def _breaches(frame: str, key: tuple[str, ...], breaches: Callable) -> Callable[[Views], DataFrame]:
    def run(view: Views) -> DataFrame:
        found = view(frame).withColumn("breach", F.explode(breaches()))
        return found.select(*key, "breach")

    return run


_CHECKS = {
    "price > 0": "price <= 0",
    "rooms >= 0": "rooms < 0",
    "size > 0": "size <= 0",
    "zip_code 1000..9999": "zip_code NOT BETWEEN 1000 AND 9999",
    "build_year 1800..2030": "build_year NOT BETWEEN 1800 AND 2030",
    "latitude -90..90": "latitude NOT BETWEEN -90 AND 90",
    "longitude -180..180": "longitude NOT BETWEEN -180 AND 180",
}


def _breach_sql(view: str, key: tuple[str, ...], not_null, extra: dict[str, str]) -> str:
    parts = {f"{c} not null": f"{c} IS NULL" for c in not_null} | _CHECKS | extra
    return sql(
        " UNION ALL ".join(
            f"SELECT {', '.join(key)}, {_quoted(name)} AS breach FROM {view} WHERE {bad}" for name, bad in parts.items()
        ),
        view,
    )


def k3(view: Views) -> DataFrame:
    return constraints.key_breaches(view("v_active"), "id")


# Rules of one's own: a listing must tell its lot, and no home has 5 rooms.
OWN_RULES = [
    rules.required("lotSize"),
    rules.Rule("rooms", "five rooms", "{numeric} AND {number} = 5"),
]


def x1(view: Views) -> DataFrame:
    return rules.errors_by_field(rules.validate(shapes.listing_items(view), OWN_RULES))


def x3(view: Views) -> DataFrame:
    return rules.validation_summary(_checked(view, enabled=False), ["page"])


def _x2(view: Views) -> DataFrame:
    """Both feeds through one and the same steps."""
    from hearthline.plans.feeds import ACTIVE, SOLD

    parts = []
    for feed, items in ((ACTIVE, shapes.listing_items(view)), (SOLD, shapes.sale_items(view))):
        checked = rules.validate(items, feed.rules_at("2024-06-30"))
        parts.append(rules.validation_summary(checked).withColumn("feed", F.lit(feed.name)))
    return parts[0].unionByName(parts[1])


def _summary(by: str, frame: str, valid: str, invalid: str, group: bool = True) -> str:
    text = SUMMARY_SQL.format(by=by, frame=frame, valid=f"WHERE {valid}", invalid=f"WHERE {invalid}")
    return text + (" GROUP BY page" if group else "")


_FIELD_COUNTS = (
    "SELECT field, message, count(*) AS error_count FROM ("
    + _errors_sql("v_listing", "id", _pairs(ACTIVE_TOLD, LISTING))
    + ") GROUP BY field, message"
)

# Fixed values, written out again: a column left out of the code must show.
NOT_NULL_ACTIVE = ("id", "price", "city", "zip_code", "street", "scraped_at", "updated_at", "version")
NOT_NULL_SOLD = ("estate_id", "address", "zip_code", "price", "sold_date", "city", "scraped_at", "updated_at", "version")



def _holed(view: str, columns: tuple[str, ...], at: str, keys: dict[str, str], feed) -> str:
    """The view with each NOT NULL column empty in some rows, next to names its rows keep."""
    kept = [f"{value} AS {name}" for name, value in keys.items()]
    values = [
        f"CASE WHEN {at} % 60 = {columns.index(c)} THEN NULL ELSE {c} END AS {c}" if c in columns else c for c in feed.columns
    ]
    return f"SELECT {', '.join([*kept, *values])} FROM {view}"


_KEYS_ACTIVE = {"key_id": "id", "key_at": "scraped_at", "k1": "o1", "k2": "o2", "k3": "o3"}
HOLED_ACTIVE = _holed("v_active", NOT_NULL_ACTIVE, "o2", _KEYS_ACTIVE, ACTIVE)
HOLED_SOLD = _holed("v_sold", NOT_NULL_SOLD, "estate_id", {"key_id": "estate_id"}, SOLD)


def _holed_breaches(view_name: str, holed: str, keys: dict[str, str], breaches: Callable) -> Callable[[Views], DataFrame]:
    def run(view: Views) -> DataFrame:
        frame = view(view_name)
        frame.createOrReplaceTempView(view_name)
        return frame.sparkSession.sql(holed).withColumn("breach", F.explode(breaches())).select(*keys, "breach")

    return run


def _holed_sql(view: str, holed: str, keys: dict[str, str], not_null, extra: dict[str, str]) -> str:
    parts = {f"{c} not null": f"{c} IS NULL" for c in not_null} | _CHECKS | extra
    told = " UNION ALL ".join(
        f"SELECT {', '.join(keys)}, {_quoted(name)} AS breach FROM holed WHERE {bad}" for name, bad in parts.items()
    )
    return sql(told, view, holed=holed)


BINDINGS = {
    "v1_required_active": _rule(None),
    "v2_required_sold": _rule(None, sold=True),
    "v3_price": _rule("price"),
    "v4_rooms": _rule("rooms"),
    "v5_size": _rule("size"),
    "v6_zip_code": _rule("zipCode"),
    "v7_build_year": _rule("buildYear"),
    "v8_latitude": _rule("latitude"),
    "v9_longitude": _rule("longitude"),
    "v10_days_for_sale": _rule("daysForSale"),
    "v11_sqm_price": _rule("sqmPrice", sold=True),
    "v12_created_date": _rule("createdDate"),
    "v13_sold_date": _rule("soldDate", sold=True),
    "k1_breaches_active": (
        bound(_breaches("v_active", LISTING_KEY, constraints.breaches_active)),
        _breach_sql("v_active", LISTING_KEY, NOT_NULL_ACTIVE, {"days_for_sale >= 0": "days_for_sale < 0"}),
    ),
    "k2_breaches_sold": (
        bound(_breaches("v_sold", ("estate_id",), constraints.breaches_sold)),
        _breach_sql("v_sold", ("estate_id",), NOT_NULL_SOLD, {"sqm_price >= 0": "sqm_price < 0"}),
    ),
    "k1_every_not_null_active": (
        bound(_holed_breaches("v_active", HOLED_ACTIVE, _KEYS_ACTIVE, constraints.breaches_active)),
        _holed_sql("v_active", HOLED_ACTIVE, _KEYS_ACTIVE, NOT_NULL_ACTIVE, {"days_for_sale >= 0": "days_for_sale < 0"}),
    ),
    "k2_every_not_null_sold": (
        bound(_holed_breaches("v_sold", HOLED_SOLD, {"key_id": "estate_id"}, constraints.breaches_sold)),
        _holed_sql("v_sold", HOLED_SOLD, {"key_id": "estate_id"}, NOT_NULL_SOLD, {"sqm_price >= 0": "sqm_price < 0"}),
    ),
    "k3_key_breaches": (
        bound(k3),
        sql("SELECT id, count(*) AS row_count FROM v_active GROUP BY id HAVING count(*) > 1", "v_active"),
    ),
    "a5_validation_summary": (
        bound(a5),
        sql(_summary("page,", "counted", "n_errors = 0", "n_errors > 0"), "v_listing", **COUNTED),
    ),
    "a6_errors_by_field": (bound(a6), sql(_FIELD_COUNTS, "v_listing")),
    "a6_reported_by_field": (bound(a6_reported), sql(_FIELD_COUNTS, "v_listing")),
    "a6_error_listing": (
        bound(a6_listing),
        sql("SELECT page, id, scraped_at, o1, o2, o3, n_errors FROM counted WHERE n_errors > 0", "v_listing", **COUNTED),
    ),
    "n2_error_budget": (
        bound(n2),
        sql(
            """SELECT page, id, scraped_at, o1, o2, o3, examined, examined AND n_errors = 0 AS is_valid,
                      CASE WHEN examined THEN n_errors ELSE 0 END AS n_errors FROM budgeted""",
            "v_listing",
            **BUDGETED,
        ),
    ),
    "n2_budget_summary": (
        bound(n2_summary),
        sql(
            _summary("page,", "budgeted", "examined AND n_errors = 0", "examined AND n_errors > 0"),
            "v_listing",
            **BUDGETED,
        ),
    ),
    "x1_own_rules": (
        bound(x1),
        sql(
            """SELECT 'lotSize' AS field, 'Required field ''lotSize'' is missing or null' AS message,
                      count(*) AS error_count FROM v_listing WHERE lot_size IS NULL
               UNION ALL
               SELECT 'rooms', 'five rooms', count(*) FROM v_listing WHERE rooms = 5""",
            "v_listing",
        ),
    ),
    "x2_both_feeds": (
        bound(_x2),
        sql(
            _summary("'active' AS feed,", "counted", "n_errors = 0", "n_errors > 0", group=False)
            + " UNION ALL "
            + _summary("'sold' AS feed,", "counted_sales", "n_errors = 0", "n_errors > 0", group=False),
            "v_listing",
            "v_sale",
            **COUNTED,
            counted_sales=f"SELECT *, {SALE_ERRORS} AS n_errors FROM v_sale",
        ),
    ),
    "x3_unchecked": (bound(x3), sql(_summary("page,", "v_listing", "true", "false"), "v_listing")),
}
