"""Costly steps stand once in the plan, however often their result is looked at."""

import json

from pyspark.sql import functions as F

from hearthline.operators import rules
from hearthline.sources import pages

GOOD = {"id": 1, "price": 1875000, "rooms": 3.5, "size": 94, "city": "Ribe", "zipCode": 6760, "street": "A 1"}


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_page_is_parsed_once(spark):
    bodies = [
        json.dumps({"meta": {"pageIndex": 3}, "results": [GOOD, GOOD]}),
        json.dumps({"meta": {"pageIndex": 4, "totalResults": 9}, "searchResults": [GOOD]}),
        "no json",
        None,
    ]
    frame = spark.createDataFrame(list(enumerate(bodies)), "n int, body string").repartition(2)
    items = pages.active_items(frame)
    assert plan(items).lower().count("parse_json") + plan(items).lower().count("parsejson") == 1
    assert sorted((r.n, r.page, r.pos) for r in items.select("n", "page", "pos").collect()) == [(0, 3, 0), (0, 3, 1), (1, 4, 0)]
    header = pages.page_header(frame)
    assert sorted((r.n, r.page, r.total_count) for r in header.collect()) == [(0, 3, 0), (1, 4, 9), (2, 0, 0), (3, 0, 0)]


def test_errors_are_put_together_once(spark):
    records = [GOOD, GOOD | {"price": None, "rooms": -1}, GOOD | {"size": 0}]
    frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "n int, body string").repartition(2)
    checked = rules.validate(frame.select("n", F.try_parse_json("body").alias("item")), rules.active_rules(2024))
    listed = rules.error_listing(checked)
    assert listed.columns == checked.columns
    told = listed.select("n", F.size("errors").alias("size"))
    assert plan(told).count("filter(array(") == 1
    assert sorted(tuple(r) for r in told.collect()) == [(1, 3), (2, 1)]
    assert plan(rules.errors_exploded(checked, "n")).count("filter(array(") == 1
