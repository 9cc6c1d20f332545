"""Writing rows into a keyed table, as one join instead of a loop.

The reference order of a batch is explicit (``order`` columns, unique per key):
a batch that holds a key several times gives the same table as writing its rows
one after the other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline import schemas
from hearthline.functions.dates import ntz

if TYPE_CHECKING:
    from hearthline.plans.feeds import Feed


@dataclass(frozen=True)
class Written:
    """The table after a write and, if asked for, what the write did. Neither has
    run yet."""

    table: DataFrame
    count: Callable[[], DataFrame]

    @property
    def stats(self) -> DataFrame:
        return self.count()


def _struct(columns: Sequence[str]) -> str:
    return f"struct({', '.join(columns)})"


def fold(batch: DataFrame, feed: Feed, order: Sequence[str]) -> DataFrame:
    """Per key: the number of rows ``n``, the payload of the ``last`` and the
    metadata of the ``first``. Rows of one key meet before the shuffle."""
    by = _struct(order)
    return batch.groupBy(feed.key).agg(
        F.expr("CAST(count(1) AS INT) AS n"),
        F.expr(f"max_by({_struct(feed.payload)}, {by}) AS last"),
        F.expr(f"min_by({_struct(schemas.METADATA)}, {by}) AS first"),
    )


def upsert(
    table: DataFrame, batch: DataFrame, feed: Feed, order: Sequence[str], as_of: datetime | str | Column
) -> Written:
    """Insert new keys and overwrite known ones, raising the version by one per row.

    Rows that break a constraint of the table fail and change nothing. A known
    key keeps ``scraped_at``; every column of the new row counts, NULLs too.

    Only rows the batch touches are joined to it; all others pass by. A batch small
    enough for Spark to broadcast its keys leaves the table where it lies.
    """
    changed = changes(table, batch, feed, order, as_of)
    keys = batch.filter(feed.storable()).select(feed.key)
    untouched = table.select(*feed.columns).join(keys, feed.key, "left_anti")
    written = untouched.unionByName(changed.select(*feed.columns))
    return Written(written, lambda: upsert_stats(table, batch, feed))


def changes(
    table: DataFrame, batch: DataFrame, feed: Feed, order: Sequence[str], as_of: datetime | str | Column
) -> DataFrame:
    """Only the rows an upsert writes, one per key, with ``old``: what the table had (NULL for a new key)."""
    folded = fold(batch.filter(feed.storable()), feed, order)
    matching = table.select(*feed.columns).join(folded.select(feed.key), feed.key, "left_semi")
    old = matching.selectExpr(feed.key, f"{_struct([*feed.payload, *schemas.METADATA])} AS old")
    touched = folded.join(old, feed.key, "left").withColumn("now", ntz(as_of))
    values = {c: f"last.{c}" for c in feed.payload}
    values |= {
        feed.key: feed.key,
        "scraped_at": "if(old IS NULL, first.scraped_at, old.scraped_at)",
        "updated_at": "if(old IS NOT NULL OR n > 1, now, first.updated_at)",
        "version": "if(old IS NOT NULL, old.version + n, first.version + n - 1)",
    }
    return touched.selectExpr(*[f"{values[c]} AS {c}" for c in feed.columns], "old")


def removals(table: DataFrame, keys: DataFrame, feed: Feed) -> DataFrame:
    """The rows of the table that go with ``keys``, as :func:`changes` gives rows, marked ``gone``."""
    gone = table.select(*feed.columns).join(keys.select(feed.key), feed.key, "left_semi")
    return gone.selectExpr(*feed.columns, f"{_struct([*feed.payload, *schemas.METADATA])} AS old", "true AS gone")


def upsert_stats(table: DataFrame, batch: DataFrame, feed: Feed) -> DataFrame:
    """total, inserted, updated and failed rows; reads keys and checked columns only."""
    key = feed.key
    keys = batch.groupBy(F.when(feed.storable(), F.col(key)).alias(key)).agg(F.expr("count(1) AS n"))
    seen = keys.join(table.selectExpr(key, "true AS known"), key, "left")
    counted = seen.agg(
        F.expr("coalesce(sum(n), 0L) AS total"),
        F.expr(f"count_if({key} IS NOT NULL AND known IS NULL) AS inserted"),
        F.expr(f"coalesce(sum(n) FILTER (WHERE {key} IS NOT NULL), 0L) AS valid"),
    )
    return counted.selectExpr("total", "inserted", "valid - inserted AS updated", "total - valid AS failed")


@dataclass(frozen=True)
class Updated:
    """The table after a write and, if asked for, the keys it does not know."""

    table: DataFrame
    look_up: Callable[[], DataFrame]

    @property
    def not_found(self) -> DataFrame:
        return self.look_up()


def update_existing(table: DataFrame, rows: DataFrame, feed: Feed, order: Sequence[str]) -> Updated:
    """Overwrite known keys: all columns but the key and ``scraped_at``, NULLs too.

    The last row of a key counts; rows the table cannot hold are passed over. As in
    :func:`upsert`, rows no update touches pass by. ``not_found`` has the keys the table does not know.
    """
    carried = [c for c in feed.columns if c not in (feed.key, "scraped_at")]
    held = rows.filter(feed.storable())
    keys = held.select(feed.key)
    last = held.groupBy(feed.key).agg(F.expr(f"max_by({_struct(carried)}, {_struct(order)}) AS new"))
    untouched = table.select(*feed.columns).join(keys, feed.key, "left_anti")
    known = table.select(feed.key, "scraped_at").join(last, feed.key)
    written = known.selectExpr(*[f"new.{c} AS {c}" if c in carried else c for c in feed.columns])
    return Updated(untouched.unionByName(written), lambda: _not_found(table, rows, feed.key))


def _not_found(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key).distinct().join(table.select(key), key, "left_anti")


def delete_keys(table: DataFrame, keys: DataFrame, key: str) -> Updated:
    """The table without the rows of ``keys``; ``not_found`` has the unknown keys."""
    return Updated(table.join(keys.select(key), key, "left_anti"), lambda: _not_found(table, keys, key))
