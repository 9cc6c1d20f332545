"""A base with deltas: what is written, what is read, and where it lies."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hearthline.functions.places import curve, curve_ranges
from hearthline.operators import merge, search
from hearthline.plans.feeds import ACTIVE, SOLD
from hearthline.sources.store import Store

AS_OF = datetime(2024, 6, 30, 12)
ORDER = ["o"]


def homes(spark, ids, price=100, step=1):
    """Homes on a grid over the map."""
    rows = spark.createDataFrame([(k,) for k in ids], "id long")
    values = {
        "id": F.col("id"), "price": F.lit(price) + F.col("id") % 7, "city": F.lit("C"), "zip_code": F.lit(8000), "street": F.lit("S"),
        "latitude": 54.5 + (F.col("id") % 100) / 30, "longitude": 8.0 + (F.col("id") / 100).cast("int") % 100 / 14,
        "scraped_at": F.lit(AS_OF), "updated_at": F.lit(AS_OF), "version": F.lit(1),
    }
    return rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ACTIVE.schema], F.lit(0).alias("o"))


def sales(spark, rows):
    made = spark.createDataFrame(rows, "estate_id long, price int, sold_date string")
    values = {
        "estate_id": F.col("estate_id"), "price": F.col("price"), "sold_date": F.col("sold_date"), "address": F.lit("A"), "city": F.lit("C"),
        "zip_code": F.lit(8000), "scraped_at": F.lit(AS_OF), "updated_at": F.lit(AS_OF), "version": F.lit(1),
    }
    return made.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SOLD.schema], F.lit(0).alias("o"))


def bring(place, rows, feed):
    """One batch as a stream brings it."""
    batch, later = place.next_batch(feed), AS_OF + timedelta(hours=1)
    place.write_delta(merge.changes(place.read_current(feed), rows, feed, ORDER, later), feed, batch)
    place.finish(feed, batch)


def state(place, feed, **how):
    return {r[0]: tuple(r) for r in place.read_current(feed, **how).collect()}


def size(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


def metric(df, name="numOutputRows"):
    """Rows that the scans of a plan handed on."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        if "AdaptiveSparkPlan" in plan.nodeName():
            plan = plan.executedPlan()
        if plan.nodeName().endswith("QueryStage"):
            plan = plan.plan()
        if plan.nodeName().startswith("Scan"):
            total += plan.metrics().get(name).get().value()
        children = plan.children()
        todo += [children.apply(k) for k in range(children.size())]
    return total


def test_deltas_equal_whole_snapshots(spark, tmp_path):
    place, whole = Store(spark, str(tmp_path / "a")), homes(spark, range(2000)).drop("o")
    place.write_current(whole, ACTIVE, 0)
    for ids, price in ((range(0, 40), 200), (range(30, 60), 300), (range(5000, 5010), 50)):
        rows = homes(spark, ids, price)
        whole = merge.upsert(whole, rows, ACTIVE, ORDER, AS_OF + timedelta(hours=1)).table
        bring(place, rows, ACTIVE)
        assert state(place, ACTIVE) == {r[0]: tuple(r) for r in whole.collect()}
    before = state(place, ACTIVE)
    assert place.batches("current", "active") == [0, 1, 2, 3] and place.open_rows(ACTIVE) == 80
    assert place.compact(ACTIVE) and state(place, ACTIVE) == before and place.open_rows(ACTIVE) == 0
    assert not place.compact(ACTIVE)
    bring(place, homes(spark, [7, 9000]), ACTIVE)
    after = state(place, ACTIVE)
    assert len(after) == len(before) + 1 and after[7][-1] == before[7][-1] + 1
    place.drop_old(ACTIVE, keep=1)
    assert state(place, ACTIVE) == after


def test_a_batch_writes_in_proportion(spark, tmp_path):
    place = Store(spark, str(tmp_path))
    place.write_current(homes(spark, range(30_000)).drop("o"), ACTIVE, 0)
    bring(place, homes(spark, range(0, 30_000, 1500), 900), ACTIVE)
    base, delta = size(tmp_path / "current/active/batch=000000000000"), size(tmp_path / "current/active/batch=000000000001")
    assert delta < base / 10
    plan = place.read_current(ACTIVE)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "hashpartitioning" not in plan


def test_removed_and_moved_rows(spark, tmp_path):
    place = Store(spark, str(tmp_path))
    place.write_current(sales(spark, [(k, 10, f"20{10 + k % 4}-05-01") for k in range(40)]).drop("o"), SOLD, 0)
    bring(place, sales(spark, [(1, 11, "2013-01-01"), (2, 12, "2014-01-01")]), SOLD)  # other years than before
    gone = merge.removals(place.read_current(SOLD), sales(spark, [(3, 1, "2010-01-01"), (99, 1, "2010-01-01")]), SOLD)
    place.write_delta(gone, SOLD, 2)
    assert len(state(place, SOLD)) == 40  # not finished: does not count
    place.finish(SOLD, 2)
    bring(place, sales(spark, [(2, 13, "2014-02-01")]), SOLD)
    want = state(place, SOLD)
    assert len(want) == 39 and 3 not in want and (want[2][3], want[2][-1]) == (13, 3)
    assert state(place, SOLD, before=2)[3][3] == 10
    assert place.compact(SOLD) and state(place, SOLD) == want
    written = {p.name for p in (tmp_path / "current/sold/base=000000000003").glob("place=*")}
    assert written == {"place=2011", "place=2012", "place=2013", "place=2014"}  # 2010 stays where it is
    assert len(state(place, SOLD, before=1)) == 40 and state(place, SOLD, before=1)[3][3] == 10
    place.drop_old(SOLD, keep=1)
    assert state(place, SOLD) == want and not (tmp_path / "current/sold/batch=000000000001").exists()


def test_a_place_may_become_empty(spark, tmp_path):
    place = Store(spark, str(tmp_path))
    place.write_current(sales(spark, [(1, 10, "2010-05-01"), (2, 10, "2011-05-01")]).drop("o"), SOLD, 0)
    bring(place, sales(spark, [(1, 11, "2011-01-01")]), SOLD)
    assert place.compact(SOLD) and {k: v[3] for k, v in state(place, SOLD).items()} == {1: 11, 2: 10}


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    place = Store(spark, str(tmp_path))
    place.write_current(homes(spark, range(0, 20_000, 2)).drop("o"), ACTIVE, 0)
    table = place.read_current(ACTIVE)
    absent, present = search.lookup(table, "id", 7001), search.lookup(table, "id", 7000)
    # the ids of every place run from the lowest to the highest: bounds alone skip nothing
    assert metric(absent) == 0 and absent.count() == 0
    assert 0 < metric(present) <= 20_000 / 2 / 16 and [r.id for r in present.collect()] == [7000]


BOXES = [(55.0, 55.2, 9.0, 9.5), (54.5, 57.8, 8.0, 15.1), (56.0, None, None, 8.4), (None, None, None, None), (80.0, 85.0, 9.0, 9.1), (55.0, 54.0, 8.0, 9.0)]
NAMES = ("latitudeMin", "latitudeMax", "longitudeMin", "longitudeMax")


@pytest.mark.parametrize("box", BOXES)
def test_box_equals_scan(spark, tmp_path_factory, box):
    place = Store(spark, str(tmp_path_factory.mktemp("box")))
    place.write_current(homes(spark, range(3000)).drop("o"), ACTIVE, 0)
    bring(place, homes(spark, range(0, 60), 400), ACTIVE)
    bounds = {n: v for n, v in zip(NAMES, box) if v is not None}
    want = search.search_active(place.read_current(ACTIVE), **bounds).collect()
    found = search.search_active(place.read_current(ACTIVE, box=bounds), **bounds).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, want))


def test_box_reads_few_row_groups(spark, tmp_path):
    """One large place, small row groups: the curve keeps areas together."""
    place = Store(spark, str(tmp_path))
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(64 * 1024))
    hadoop.set("parquet.block.size.row.check.min", "100")
    try:
        table = homes(spark, range(10_000)).withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(5)))).withColumn("id", F.col("id") * 6 + F.col("p"))
        rows = table.drop("o", "p").withColumn("place", F.lit(0))
        place._write_places(rows.repartition(1), ACTIVE, f"{tmp_path}/one")
    finally:
        hadoop.unset("parquet.block.size")
        hadoop.unset("parquet.block.size.row.check.min")
    box = dict(zip(NAMES, (55.0, 55.2, 9.0, 9.5)))
    from hearthline.sources.store import _on_curve

    read = spark.read.parquet(f"{tmp_path}/one").filter(_on_curve(box))
    assert search.search_active(read, **box).count() == search.search_active(spark.read.parquet(f"{tmp_path}/one"), **box).count() > 0
    assert metric(read) < 60_000 / 4


def test_curve_and_its_ranges(spark):
    points = [(-90.0, -180.0), (90.0, 180.0), (55.7, 12.6), (55.7001, 12.6001), (0.0, 0.0), (None, 3.0), (200.0, -500.0)]
    made = spark.createDataFrame(points, "lat double, lon double").select("lat", curve(F.col("lat"), F.col("lon")).alias("c"))
    places = [r.c for r in made.collect()]
    assert places[0] == 0 and places[1] == (1 << 32) - 1 and places[5] is None and 0 <= places[6] < 1 << 32
    assert abs(places[2] - places[3]) < 1 << 12
    for box in BOXES[:5]:
        ranges = curve_ranges(*box)
        assert len(ranges) <= 32 and all(a <= b for a, b in ranges)
        inside = [p for (lat, lon), p in zip(points, places) if lat is not None and all(
            bound is None or (value >= bound if k % 2 == 0 else value <= bound) for k, (value, bound) in enumerate(zip((lat, lat, lon, lon), box)))]
        assert all(any(a <= p <= b for a, b in ranges) for p in inside)
