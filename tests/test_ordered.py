import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hearthline.operators import ordered as module
from hearthline.operators.ordered import beside_group, hot_groups, ordered


def skewed(spark, n=3000):
    """One key has a third of the rows, one is NULL, the order has a hot value."""
    chance = random.Random(7)
    rows = []
    for i in range(n):
        key = 1 if i % 3 == 0 else (None if i % 50 == 1 else chance.randrange(2, 200))
        at = 5 if i % 4 == 0 else chance.randrange(100)
        rows.append((key, at, i, chance.choice([None, 1, 2, 3])))
    chance.shuffle(rows)
    return spark.createDataFrame(rows, "k int, at int, seq int, v int")


def plain(df, groups):
    w = W.partitionBy(*groups).orderBy("at", "seq")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    return df.select(
        "seq", F.row_number().over(w).cast("long").alias("n"), F.sum("v").over(upto).alias("total"),
        F.min("v").over(upto).alias("least"), F.lag("v").over(w).alias("before"), F.lead("v").over(w).alias("after"),
    )


@pytest.mark.parametrize("groups", [["k"], []])
@pytest.mark.parametrize("tuning", [{}, {"hot_rows": 10, "parts": 64}, {"hot_rows": 3, "parts": 4096}, {"hot_rows": 3, "parts": 4}])
def test_equals_a_plain_window(spark, groups, tuning):
    df = skewed(spark)
    got = ordered(
        df, groups, ["at", "seq"], number="n", sums={"total": "v"}, mins={"least": "v"}, lags={"before": "v"},
        leads={"after": "v"}, **tuning,
    )
    assert got.columns == [*df.columns, "n", "total", "least", "before", "after"]
    want = {tuple(r) for r in plain(df, groups).collect()}
    assert {tuple(r) for r in got.select("seq", "n", "total", "least", "before", "after").collect()} == want


def test_block_tables_are_cut_as_well(spark, monkeypatch):
    """With no table small enough to broadcast, blocks of blocks give the same."""
    monkeypatch.setattr(module, "SMALL", 5)
    df = skewed(spark, 1500)
    got = ordered(df, ["k"], ["at", "seq"], number="n", sums={"total": "v"}, mins={"least": "v"}, lags={"before": "v"},
                  leads={"after": "v"}, hot_rows=4, parts=8)
    want = {tuple(r) for r in plain(df, ["k"]).collect()}
    assert {tuple(r) for r in got.select("seq", "n", "total", "least", "before", "after").collect()} == want


def test_bounded_groups_and_sums_of_doubles(spark):
    df = skewed(spark, 300)
    got = ordered(df, ["k"], ["at", "seq"], number="n", bounded=True, hot_rows=3)
    assert {(r.seq, r.n) for r in got.collect()} == {(r.seq, r.n) for r in plain(df, ["k"]).collect()}
    with pytest.raises(TypeError, match="decimal"):
        ordered(df.withColumn("v", F.col("v").cast("double")), ["k"], ["seq"], sums={"total": "v"})


def test_hot_groups_are_few(spark):
    df = skewed(spark)
    hot = hot_groups(df, ["k"], 10, 64).collect()
    assert {r.k for r in hot} == {1} and len(hot) <= 16
    # A step of about 3000 / 64 rows: the hot key falls into some twenty blocks.
    assert all(r["_step"] == 47 for r in hot)


@pytest.mark.parametrize("tuning", [{}, {"hot_rows": 10, "parts": 64}])
def test_group_facts_beside_rows(spark, tuning):
    df = skewed(spark)
    got = {r.seq: (r.top, r.n) for r in beside_group(df, ["k"], {"top": F.max("at"), "n": F.count("*")}, **tuning).collect()}
    sizes = {r.k: (r.top, r.n) for r in df.groupBy("k").agg(F.max("at").alias("top"), F.count("*").alias("n")).collect()}
    want = {r.seq: (None, None) if r.k is None else sizes[r.k] for r in df.collect()}
    assert got == want


def test_many_blocks_of_one_group_are_looked_up_without_a_join(spark):
    """Rows of a whole table find one of many blocks by halving; no row carries the splitters along."""
    rows = [(None if k % 501 == 0 else k * 7919 % 613, k, f"x{k % 7}") for k in range(12_000)]
    table = spark.createDataFrame(rows, "day int, id long, other string").repartition(3)
    out = ordered(table, [], ["day", "id"], number="n", hot_rows=40)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [tuple(r)[:3] for r in out.orderBy("n").collect()] == want
    assert sorted(r["n"] for r in out.select("n").collect()) == list(range(1, 12_001))
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert len(joins) == 2  # with the groups that are cut, and with the totals before each block
