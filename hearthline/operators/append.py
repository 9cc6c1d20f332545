"""Strict insert in batches: a batch goes in whole or not at all.

Batches are taken in number order. A batch fails if one of its rows breaks a
constraint, has a key the table holds, a key that is twice in the batch, or a key
that an earlier batch put in.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import TYPE_CHECKING

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.operators.merge import Written
from hearthline.operators.ordered import ordered
from hearthline.sources.scratch import kept, shared_folder

if TYPE_CHECKING:
    from hearthline.plans.feeds import Feed

BATCH_SIZE = 1000
#: Contested pairs of batch and key that one task settles in order.
BLOCK = 200_000


def number_batches(rows: DataFrame, order: Sequence[str], batch_size: int = BATCH_SIZE, **tuning) -> DataFrame:
    """``rows`` with ``batch``: every ``batch_size`` rows of the whole order, from 0."""
    numbered = ordered(rows, [], order, number="_position", **tuning)
    return numbered.withColumn("batch", F.floor((F.col("_position") - 1) / batch_size)).drop("_position")


def _failed_batches(table: DataFrame, pairs: DataFrame, feed: Feed) -> DataFrame:
    """The batches that fail; ``pairs`` has ``batch``, the key and ``held`` of every row."""
    key = feed.key
    held = kept(
        pairs.groupBy("batch", key)
        .agg((F.count_if(~F.col("held")) + F.count(F.lit(1)) - 1).alias("_faults"))
        .join(table.select(key, F.lit(1).alias("_known")), key, "left")
        .select("batch", key, (F.col("_faults") + F.coalesce("_known", F.lit(0)) > 0).alias("_bad"))
    )
    alone = held.groupBy("batch").agg(F.bool_or("_bad").alias("_bad"))
    failed = kept(alone.filter("_bad").select("batch"))

    # What is left can only fail over a key two sound batches share.
    sound = held.join(failed, "batch", "left_anti").select("batch", key)
    shared = sound.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key)
    contested = sound.join(shared, key, "left_semi")
    return failed.unionByName(_losers(contested, key))


def _settle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches of a block, in order: each enters if none of its keys is taken yet.

    The last batch may lie partly outside the block: it is left open if the block is full.
    """
    taken: set = set()
    entered: list[tuple[int, bool]] = []
    batch, keys, seen = None, [], 0

    def close() -> None:
        goes_in = taken.isdisjoint(keys)
        if goes_in:
            taken.update(keys)
        entered.append((batch, goes_in))

    for frame in frames:
        for number, key in zip(frame["batch"].tolist(), frame["key"].tolist()):
            if number != batch:
                if batch is not None:
                    close()
                batch, keys = number, []
            keys.append(key)
            seen += 1
        limit = int(frame["most"].iat[0]) if len(frame) else 0
    if batch is not None and seen < limit:
        close()
    yield pd.DataFrame(entered, columns=["batch", "enters"])


def _losers(contested: DataFrame, key: str, block: int = BLOCK) -> DataFrame:
    """Batches that lose a contested key to an earlier batch that goes in.

    Each round settles the first ``block`` pairs of batch and key, along the batch order, in
    one task, and everywhere else the batches that are first on all their keys. Whoever
    shares a key with one that enters is out; only pairs still contested are carried on.
    So there are at most as many rounds as blocks of pairs, however the batches wait for
    each other, and usually one.
    """
    spark, folder = contested.sparkSession, shared_folder(contested.sparkSession)
    losers = f"{folder}/losers"
    spark.createDataFrame([], "batch long").write.parquet(losers)
    pairs = contested.select(F.col("batch").cast("long").alias("batch"), F.col(key).cast("string").alias("key"))
    pairs.write.parquet(f"{folder}/open=0")
    nth = 0
    while True:
        open_ = spark.read.schema("batch long, key string").parquet(f"{folder}/open={nth}")
        if open_.isEmpty():
            return spark.read.schema("batch long").parquet(losers)
        first = open_.groupBy("key").agg(F.min("batch").alias("first"))
        entering = open_.join(first, "key").groupBy("batch").agg(F.bool_and(F.col("batch") == F.col("first")).alias("enters"))
        near = open_.orderBy("batch", "key").limit(block).coalesce(1).sortWithinPartitions("batch", "key")
        settled = near.withColumn("most", F.lit(block)).mapInPandas(_settle, "batch long, enters boolean")
        winners = kept(entering.filter("enters").select("batch").unionByName(settled.filter("enters").select("batch")).distinct())
        taken = kept(open_.join(winners, "batch", "left_semi").select("key").distinct())
        out = kept(open_.join(taken, "key", "left_semi").select("batch").distinct().join(winners, "batch", "left_anti"))
        out.write.mode("append").parquet(losers)
        rest = open_.join(winners.unionByName(out), "batch", "left_anti")
        alone = rest.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select("key")
        nth += 1
        rest.join(alone, "key", "left_anti").write.parquet(f"{folder}/open={nth}")


def bulk_append(table: DataFrame, rows: DataFrame, feed: Feed) -> Written:
    """``rows`` (with a ``batch`` number, see :func:`number_batches`) added to the
    table; stats inserted, failed and total.

    Runs at once: the batch and key of every row are written, then settled in small jobs while
    batches contest keys. Batches that wait for each other in a chain cost no more rounds
    than others (see :func:`_losers`).
    """
    # Numbering is dear: what decides is written once, and the rows are made again only to enter.
    pairs = kept(rows.select("batch", feed.key, feed.storable().alias("held")))
    failed = kept(_failed_batches(table, pairs, feed))
    entered = rows.join(failed, "batch", "left_anti")

    def count() -> DataFrame:
        sizes = pairs.groupBy("batch").agg(F.expr("count(1) AS n"))
        outcome = sizes.join(failed.selectExpr("batch", "true AS lost"), "batch", "left")
        return outcome.selectExpr(
            "coalesce(sum(n) FILTER (WHERE lost IS NULL), 0L) AS inserted",
            "coalesce(sum(n) FILTER (WHERE lost), 0L) AS failed",
            "coalesce(sum(n), 0L) AS total",
        )

    columns = feed.columns
    return Written(table.select(*columns).unionByName(entered.select(*columns)), count)


def insert_one(table: DataFrame, row: DataFrame, feed: Feed) -> Written:
    """One row added if the table can hold it and does not know its key. Nothing runs yet."""
    entered = row.filter(feed.storable()).join(table.select(feed.key), feed.key, "left_anti")

    def count() -> DataFrame:
        told = row.selectExpr("0L AS entered", "1L AS given").unionByName(
            entered.selectExpr("1L AS entered", "0L AS given")
        )
        return told.selectExpr("entered", "given").groupBy().agg(
            F.expr("coalesce(sum(entered), 0L) AS inserted"),
            F.expr("coalesce(sum(given) - sum(entered), 0L) AS failed"),
            F.expr("coalesce(sum(given), 0L) AS total"),
        )

    columns = feed.columns
    return Written(table.select(*columns).unionByName(entered.select(*columns)), count)
