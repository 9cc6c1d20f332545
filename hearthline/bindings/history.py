"""Versions, duplicates and snapshot differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.bindings import shapes
from hearthline.bindings.views import AS_OF, ORDER, Views, bound, sql
from hearthline.functions.scalars import checksum
from hearthline.operators import history, merge
from hearthline.plans.feeds import ACTIVE

BY = "scraped_at, o1, o2, o3"


def _versioned(view: Views) -> DataFrame:
    """Sightings with versions that tie."""
    return view("v_active").withColumn("version", (1 + F.col("o1") % 3).cast("int"))


VERSIONED = {"versioned": "SELECT * EXCLUDE (version), CAST(1 + o1 % 3 AS INT) AS version FROM v_active"}


def n1(view: Views) -> DataFrame:
    return history.dedup_latest(_versioned(view), "id").table.select("id", *ORDER, "version", "price")


def n1_stats(view: Views) -> DataFrame:
    return history.dedup_latest(_versioned(view), "id").stats


def a4(view: Views) -> DataFrame:
    return history.find_duplicates(_versioned(view), "id")


def n5(view: Views) -> DataFrame:
    walked = history.version_history(view("v_held"), "id", ORDER)
    return walked.select(
        "id", *ORDER, "version_no", "old_price", F.col("price").alias("new_price"),
        "change_percent", "valid_from", "valid_to",
    )


def q6(view: Views) -> DataFrame:
    return history.price_development(view("v_held"), "id", ORDER)


def w4(view: Views) -> DataFrame:
    """The table before the cut against the table after it, less the homes last
    seen for sale longest ago."""
    old = shapes.active_table(view)
    new = merge.upsert(old, shapes.after(view("v_active")), ACTIVE, ORDER, AS_OF).table
    return history.refresh_diff(old, new.filter("days_for_sale < 190"), "id", ACTIVE.payload)


def w5(view: Views) -> DataFrame:
    return history.cross_id_duplicates(view("v_held"))


def w5_unknown(view: Views) -> DataFrame:
    """Homes of which some know no street, zip code or size."""
    unknown = {"street": 3, "zip_code": 5, "size": 7}
    held = view("v_held")
    return history.cross_id_duplicates(
        held.withColumns({c: F.when(F.col("id") % n != 0, F.col(c)) for c, n in unknown.items()})
    )


def f4(view: Views) -> DataFrame:
    return view("v_active").select("id", *ORDER, checksum("id", "price", "size", "zip_code", "street").alias("checksum"))


_SAME = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in ACTIVE.payload)

BINDINGS = {
    "n1_dedup_latest": (
        bound(n1),
        sql(
            f"""SELECT id, {BY}, version, price FROM (
                  SELECT *, max(version) OVER (PARTITION BY id) AS top FROM versioned) WHERE version = top""",
            "v_active",
            **VERSIONED,
        ),
    ),
    "n1_dedup_stats": (
        bound(n1_stats),
        sql(
            """SELECT count(*) FILTER (WHERE n > 1) AS duplicates_found, CAST(sum(n - kept) AS BIGINT) AS duplicates_removed
               FROM (SELECT id, count(*) AS n, count(*) FILTER (WHERE version = top) AS kept
                     FROM (SELECT *, max(version) OVER (PARTITION BY id) AS top FROM versioned) GROUP BY id)""",
            "v_active",
            **VERSIONED,
        ),
    ),
    "a4_find_duplicates": (
        bound(a4),
        sql(
            """SELECT id, count(*) AS row_count, max(version) AS max_version FROM versioned
               GROUP BY id HAVING count(*) > 1""",
            "v_active",
            **VERSIONED,
        ),
    ),
    "n5_version_history": (
        bound(n5),
        sql(
            f"""SELECT id, {BY}, version_no, old_price, price AS new_price,
                       (price - old_price) / CAST(old_price AS DOUBLE) * 100 AS change_percent,
                       scraped_at AS valid_from, valid_to
                FROM (SELECT *, row_number() OVER w AS version_no, lag(price) OVER w AS old_price,
                             lead(scraped_at) OVER w AS valid_to
                      FROM v_held WINDOW w AS (PARTITION BY id ORDER BY {BY}))""",
            "v_held",
        ),
    ),
    "q6_price_development": (
        bound(q6),
        sql(
            f"""SELECT id, price AS last_price, old_price AS previous_price,
                       CASE WHEN price < old_price THEN 'down' WHEN price > old_price THEN 'up' ELSE 'same' END AS development
                FROM (SELECT *, lag(price) OVER w AS old_price, lead(id) OVER w AS further, count(*) OVER (PARTITION BY id) AS n
                      FROM v_held WINDOW w AS (PARTITION BY id ORDER BY {BY}))
                WHERE further IS NULL AND n > 1""",
            "v_held",
        ),
    ),
    "w4_refresh_diff": (
        bound(w4),
        sql(
            f"""SELECT coalesce(a.id, b.id) AS id,
                       CASE WHEN a.id IS NULL THEN 'new' WHEN b.id IS NULL THEN 'gone'
                            WHEN {_SAME} THEN 'same' ELSE 'changed' END AS change
                FROM old a FULL JOIN (SELECT * FROM merged WHERE days_for_sale < 190) b ON a.id = b.id""",
            "v_held",
            **shapes.tables_sql(ACTIVE),
        ),
    ),
    "w5_cross_id_duplicates": (
        bound(w5),
        sql(
            r"""SELECT regexp_replace(lower(trim(street)), '\s+', ' ', 'g') AS street_norm, zip_code, size,
                      count(DISTINCT id) AS id_count, min(id) AS kept_id
               FROM v_held WHERE street IS NOT NULL AND zip_code IS NOT NULL AND size IS NOT NULL
               GROUP BY 1, 2, 3 HAVING count(DISTINCT id) > 1""",
            "v_held",
        ),
    ),
    "w5_unknown_places": (
        bound(w5_unknown),
        sql(
            r"""SELECT regexp_replace(lower(trim(street)), '\s+', ' ', 'g') AS street_norm, zip_code, size,
                      count(DISTINCT id) AS id_count, min(id) AS kept_id FROM places
               WHERE street IS NOT NULL AND zip_code IS NOT NULL AND size IS NOT NULL
               GROUP BY 1, 2, 3 HAVING count(DISTINCT id) > 1""",
            "v_held",
            places="""SELECT id, CASE WHEN id % 3 = 0 THEN NULL ELSE street END AS street,
                             CASE WHEN id % 5 = 0 THEN NULL ELSE zip_code END AS zip_code,
                             CASE WHEN id % 7 = 0 THEN NULL ELSE size END AS size FROM v_held""",
        ),
    ),
    "f4_checksum": (
        bound(f4),
        sql(
            """SELECT id, scraped_at, o1, o2, o3, sha256(concat('{"id":', id,
                 CASE WHEN price IS NULL THEN '' ELSE concat(',"price":', price) END,
                 ',"size":', size, ',"zip_code":', zip_code, ',"street":"', street, '"}')) AS checksum FROM v_active""",
            "v_active",
        ),
    ),
}
