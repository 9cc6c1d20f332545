import json

import pytest
from pyspark.sql import functions as F

from hearthline.functions.variants import TERMS
from hearthline.operators import constraints, rules
from hearthline.plans.feeds import ACTIVE, SOLD

GOOD = {"id": 1, "price": 1875000, "rooms": 3.5, "size": 94, "city": "Ribe", "zipCode": 6760, "street": "A 1"}
GOOD_SALE = {
    "estateId": 1, "address": "A 1", "zipCode": 8000, "price": 100, "soldDate": "2024-05-01", "city": "Ribe",
}
GONE = object()


def checked(spark, records, all_rules):
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    items = spark.createDataFrame(rows, "n int, body string").select("n", F.try_parse_json("body").alias("item"))
    found = rules.validate(items, all_rules).orderBy("n").collect()
    for row in found:
        assert row.is_valid == (not row.errors)
    return [[(e.field, e.message.split(" ")[0]) for e in r.errors] for r in found]


def with_field(base, field, value):
    record = dict(base)
    if value is GONE:
        record.pop(field, None)
    else:
        record[field] = value
    return record


REQ = "Required"
ACTIVE_CASES = [
    ("price", GONE, [REQ]), ("price", None, [REQ, "Price"]), ("price", 0, ["Price"]), ("price", -1, ["Price"]),
    ("price", 0.5, []), ("price", 1.9, []), ("price", "12", ["Price"]), ("price", True, ["Price"]),
    ("price", 1e3, []), ("price", 99999999999999999999, []), ("price", [1], ["Price"]),
    ("rooms", GONE, [REQ]), ("rooms", None, [REQ]), ("rooms", 0, []), ("rooms", -0.5, ["Rooms"]), ("rooms", "4", ["Rooms"]),
    ("size", 0, ["Size"]), ("size", 0.5, []), ("size", None, [REQ]), ("size", {}, ["Size"]),
    ("zipCode", GONE, [REQ]), ("zipCode", None, [REQ, "zipCode"]), ("zipCode", 999, ["zipCode"]), ("zipCode", 1000, []),
    ("zipCode", 9999, []), ("zipCode", 10000, ["zipCode"]), ("zipCode", 2100.0, ["zipCode"]), ("zipCode", "2100", ["zipCode"]),
    ("zipCode", 99999999999999999999, ["zipCode"]),
    ("buildYear", GONE, []), ("buildYear", None, []), ("buildYear", 1799, ["buildYear"]), ("buildYear", 1800, []),
    ("buildYear", 2024, []), ("buildYear", 2025, ["buildYear"]), ("buildYear", 2030, ["buildYear"]),
    ("buildYear", 1900.0, ["buildYear"]),
    ("latitude", 90, []), ("latitude", -90.0, []), ("latitude", 90.01, ["latitude"]), ("latitude", "55", ["latitude"]),
    ("longitude", 180, []), ("longitude", -180.5, ["longitude"]), ("longitude", None, []),
    ("daysForSale", -1, ["daysForSale"]), ("daysForSale", 3.7, []), ("daysForSale", None, []),
    ("createdDate", "2024-05-01", []), ("createdDate", "2024-05-01T10:00:00Z", []),
    ("createdDate", "2024-05-01T10:00:00+02:00", []), ("createdDate", "2024", ["Invalid"]), ("createdDate", "", []),
    ("createdDate", None, []), ("createdDate", 5, ["Invalid"]), ("createdDate", 0, []), ("createdDate", False, []),
    ("createdDate", True, ["Invalid"]), ("createdDate", [], []), ("createdDate", {}, []), ("createdDate", [1], ["Invalid"]),
    ("id", "x", []), ("street", "", []), ("city", None, [REQ]),
]
SOLD_CASES = [
    ("soldDate", GONE, [REQ]), ("soldDate", None, [REQ]), ("soldDate", "", []), ("soldDate", "2024-05", ["Invalid"]),
    ("sqmPrice", -0.01, ["sqmPrice"]), ("sqmPrice", 0, []), ("sqmPrice", None, []), ("rooms", None, []), ("size", GONE, []),
    ("estateId", GONE, [REQ]), ("address", None, [REQ]), ("price", None, [REQ, "Price"]),
]


@pytest.mark.parametrize(
    "base, cases, make", [(GOOD, ACTIVE_CASES, rules.active_rules), (GOOD_SALE, SOLD_CASES, rules.sold_rules)]
)
def test_edge_records(spark, base, cases, make):
    got = checked(spark, [base] + [with_field(base, f, v) for f, v, _ in cases], make(2024))
    assert got[0] == []
    wanted = [[(f, start) for start in starts] for f, _, starts in cases]
    assert list(zip(cases, got[1:])) == list(zip(cases, wanted))


def test_error_report_and_own_rules(spark):
    own = [rules.Rule("price", "dear", "{numeric} AND {number} > 10"), rules.required("lotSize")]
    item = spark.createDataFrame([('{"price": 11.5}',)], "b string").select(F.parse_json("b").alias("item"))
    row = rules.validate(item, own).first()
    assert [tuple(e) for e in row.errors] == [
        ("price", "11.5", "dear"),
        ("lotSize", None, "Required field 'lotSize' is missing or null"),
    ]
    assert set(TERMS) >= {"present", "given", "numeric", "integral", "number", "text", "truthy"}
    off = rules.validate(item, own, enabled=False).first()
    assert off.is_valid and off.errors == []


def test_summary_of_nothing(spark):
    nothing = spark.createDataFrame([], "is_valid boolean, errors " + rules.ERRORS)
    assert rules.validation_summary(nothing).first().asDict() == {
        "valid_count": 0, "invalid_count": 0, "total_count": 0, "success_rate": 0.0,
    }


@pytest.mark.parametrize("tuning", [{}, {"hot_rows": 2, "parts": 16}])
def test_error_budget_stops_in_the_middle(spark, tuning):
    counts = [0, 2, 0, 1, 0, 3, 0, 0, 1]
    rows = [(p, i, n) for p in (1, 2) for i, n in enumerate(counts if p == 1 else [0, 0, 1])]
    made = spark.createDataFrame(rows, "page int, pos int, n int").selectExpr(
        "page", "pos", f"CAST(array_repeat(named_struct('field', 'f', 'value', 'v', 'message', 'm'), n) AS {rules.ERRORS}) AS errors",
        "n = 0 AS is_valid",
    )
    spent = rules.error_budget(made, "page", ["pos"], 3, **tuning)
    got = {(r.page, r.pos): r for r in spent.collect()}
    assert [got[1, i].examined for i in range(9)] == [True] * 4 + [False] * 5
    assert all(got[2, i].examined for i in range(3))
    summary = {r.page: r for r in rules.validation_summary(spent, ["page"]).collect()}
    assert (summary[1].valid_count, summary[1].invalid_count, summary[1].total_count) == (2, 2, 9)


def test_breaches(spark):
    row = {c: None for c in ACTIVE.columns} | {
        "id": 1, "price": 0, "rooms": -1.0, "size": 0, "zip_code": 999, "build_year": 2031, "latitude": 91.0,
        "longitude": 181.0, "days_for_sale": -1, "city": "c", "version": 1,
    }
    table = spark.createDataFrame([row], ACTIVE.schema)
    assert set(table.select(constraints.breaches_active().alias("b")).first().b) == {
        "street not null", "scraped_at not null", "updated_at not null", "price > 0", "rooms >= 0", "size > 0",
        "zip_code 1000..9999", "build_year 1800..2030", "latitude -90..90", "longitude -180..180", "days_for_sale >= 0",
    }
    sold = spark.createDataFrame([{c: None for c in SOLD.columns} | {"sqm_price": -1.0}], SOLD.schema)
    found = sold.select(constraints.breaches_sold().alias("b"), constraints.storable_sold().alias("ok")).first()
    assert "sqm_price >= 0" in found.b and "estate_id not null" in found.b and found.ok is False
