"""Refresh, incremental load and report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.operators import ledger, merge, rules, search, stats
from hearthline.plans.feeds import Feed
from hearthline.sources import pages as sources

ITEM_ORDER = ("page_time", "page_path", "page", "pos")


@dataclass(frozen=True)
class Ingest:
    """A load that has not run yet, step by step."""

    validated: DataFrame
    rows: DataFrame
    table: DataFrame
    stats: DataFrame


def validated_items(
    pages: DataFrame,
    feed: Feed,
    as_of: datetime | str,
    validate: bool = True,
    max_errors: int | None = None,
    order: Sequence[str] = ITEM_ORDER,
) -> DataFrame:
    """The records on the pages with their errors.

    With ``max_errors`` a page is given up once it has that many errors.
    """
    items = sources.items(pages, feed.first_page)
    checked = rules.validate(items, feed.rules_at(as_of), enabled=validate)
    if max_errors is None or not validate:
        return checked
    page = [c for c in order if c != "pos"]
    return rules.error_budget(checked, page, ["pos"], max_errors, bounded=True)


def ingest(
    pages: DataFrame,
    table: DataFrame,
    feed: Feed,
    as_of: datetime | str,
    validate: bool = True,
    max_errors: int | None = None,
    order: Sequence[str] = ITEM_ORDER,
) -> Ingest:
    """Pages to table: read, validate, map, upsert."""
    checked = validated_items(pages, feed, as_of, validate, max_errors, order)
    rows = feed.to_rows(checked.filter("is_valid"), as_of, *order)
    written = merge.upsert(table, rows, feed, order, as_of)
    return Ingest(checked, rows, written.table, batch_stats(checked, written.stats))


def batch_stats(validated: DataFrame, upsert_stats: DataFrame) -> DataFrame:
    """processed, inserted, updated and failed, where failed counts both invalid
    records and rows the table refused."""
    summary = rules.validation_summary(validated).select(
        F.col("total_count").alias("processed"),
        F.lit(0).cast("long").alias("inserted"),
        F.lit(0).cast("long").alias("updated"),
        F.col("invalid_count").alias("failed"),
    )
    stored = upsert_stats.select(F.lit(0).cast("long").alias("processed"), "inserted", "updated", "failed")
    names = ("processed", "inserted", "updated", "failed")
    return summary.unionByName(stored).agg(*[F.sum(c).alias(c) for c in names])


def arrived_stats(arrived: DataFrame, delta: DataFrame) -> DataFrame:
    """As :func:`batch_stats`, from stored records that say whether the table took them, and
    the stored rows the table changed: neither reads the table."""
    counted = arrived.selectExpr(
        "1L AS processed", "0L AS inserted", "if(taken, 1L, 0L) AS updated", "if(taken, 0L, 1L) AS failed"
    )
    new = delta.filter("NOT known").selectExpr(
        "0L AS processed", "1L AS inserted", "-1L AS updated", "0L AS failed"
    )
    names = ("processed", "inserted", "updated", "failed")
    return counted.unionByName(new).agg(*[F.expr(f"coalesce(sum({c}), 0L) AS {c}") for c in names])


def incremental(
    pages: DataFrame, table: DataFrame, feed: Feed, as_of: datetime | str, days: int = 7, **how
) -> Ingest:
    """As :func:`ingest`, for the sales of the last ``days`` days only."""
    checked = validated_items(pages, feed, as_of, **how)
    order = how.get("order", ITEM_ORDER)
    rows = search.sold_since(feed.to_rows(checked.filter("is_valid"), as_of, *order), as_of, days)
    written = merge.upsert(table, rows, feed, order, as_of)
    return Ingest(checked, rows, written.table, batch_stats(checked, written.stats))


def load_records(
    items: DataFrame, table: DataFrame, feed: Feed, as_of: datetime | str, order: Sequence[str]
) -> merge.Written:
    """Records (VARIANT) under table column names upserted one by one.

    Stats: total counts every record; failed those that lack a required key and those the
    table refuses.
    """
    from hearthline.operators.mapping import lacking_records, snake_records

    given = snake_records(items, feed.schema, feed.required, as_of, *order)
    complete = given.filter("size(missing) = 0").drop("missing")
    written = merge.upsert(table, complete, feed, order, as_of)

    def count() -> DataFrame:
        lost = lacking_records(items, feed.required).selectExpr(
            "1L AS total", "0L AS inserted", "0L AS updated", "1L AS failed"
        )
        return written.stats.unionByName(lost).agg(
            *[F.sum(c).alias(c) for c in ("total", "inserted", "updated", "failed")]
        )

    return merge.Written(written.table, count)


@dataclass(frozen=True)
class Report:
    active: DataFrame
    sold: DataFrame
    runs: DataFrame


def report(active: DataFrame, sold: DataFrame, runs: DataFrame) -> Report:
    """Figures of both tables and of the runs."""
    return Report(stats.table_stats(active), stats.table_stats(sold), ledger.run_stats(runs))


def quick_load(
    items: DataFrame, table: DataFrame, feed: Feed, as_of: datetime | str, order: Sequence[str]
) -> merge.Written:
    """Unvalidated records through the short mapping into the table."""
    from hearthline.operators.mapping import quick_map

    return merge.upsert(table, quick_map(items, as_of, *order), feed, order, as_of)
