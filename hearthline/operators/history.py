"""Versions of a home, duplicates and differences between snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hearthline.functions.scalars import checksum, zero_if_null
from hearthline.operators.ordered import beside_group, ordered


@dataclass(frozen=True)
class Deduplicated:
    table: DataFrame
    stats: DataFrame


def find_duplicates(table: DataFrame, key: str) -> DataFrame:
    """Keys held by several rows, with their number and the highest version."""
    return (
        table.groupBy(key)
        .agg(F.count(F.lit(1)).alias("row_count"), F.max("version").alias("max_version"))
        .filter("row_count > 1")
    )


def dedup_latest(table: DataFrame, key: str, **tuning) -> Deduplicated:
    """Drop rows below the key's highest version; rows that tie for it all stay.

    Stats: keys found with several rows, rows removed.
    """
    beside = beside_group(table, [key], {"_max": F.max("version")}, **tuning)
    keep = F.coalesce(F.col("version") >= F.col("_max"), F.lit(True))
    # Per (key, version) first, so that counting needs no row twice.
    versions = table.groupBy(key, "version").agg(F.count(F.lit(1)).alias("_n"))
    per_key = versions.groupBy(key).agg(
        F.sum("_n").alias("_rows"),
        F.max_by("_n", "version").alias("_kept"),
        F.sum(F.when(F.col("version").isNull(), F.col("_n"))).alias("_unversioned"),
    )
    dropped = F.when(
        F.col(key).isNotNull() & F.col("_kept").isNotNull(),
        F.col("_rows") - F.col("_kept") - zero_if_null(F.col("_unversioned")),
    )
    stats = per_key.agg(
        F.count_if(F.col("_rows") > 1).alias("duplicates_found"),
        zero_if_null(F.sum(dropped)).alias("duplicates_removed"),
    )
    return Deduplicated(beside.filter(keep).select(*table.columns), stats)


def version_history(hits: DataFrame, key: str, order: Sequence[str], seen_at: str = "scraped_at", **tuning) -> DataFrame:
    """Every hit of a home numbered from 1, with the price before, the change in
    percent (NULL after a price of zero) and the time it was in force."""
    walked = ordered(
        hits,
        [key],
        order,
        number="version_no",
        lags={"old_price": "price"},
        leads={"valid_to": seen_at},
        **tuning,
    )
    change = F.try_divide(F.col("price") - F.col("old_price"), F.col("old_price")) * 100
    return walked.withColumns({"change_percent": change, "valid_from": F.col(seen_at)})


def price_development(hits: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Per home with two hits or more: ``last_price``, ``previous_price`` and
    ``development`` (down, up or same). Only two rows of a home leave each task."""
    newest = W.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    last_two = (
        hits.select(key, "price", *[c for c in order if c not in (key, "price")])
        .withColumn("_rank", F.row_number().over(newest))
        .filter("_rank <= 2")
    )
    last = F.max(F.when(F.col("_rank") == 1, F.col("price")))
    previous = F.max(F.when(F.col("_rank") == 2, F.col("price")))
    pairs = last_two.groupBy(key).agg(
        last.alias("last_price"), previous.alias("previous_price"), F.count(F.lit(1)).alias("_n")
    )
    development = (
        F.when(F.col("last_price") < F.col("previous_price"), "down")
        .when(F.col("last_price") > F.col("previous_price"), "up")
        .when(F.col("last_price") == F.col("previous_price"), "same")
    )
    return pairs.filter("_n = 2").drop("_n").withColumn("development", development)


def row_hash(table: DataFrame, columns: Sequence[str]) -> Column:
    """Checksum of a row's content for change detection."""
    return checksum(*columns)


def refresh_diff(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Per key of two full snapshots: ``new``, ``gone``, ``changed`` or ``same``.

    Only the key and a checksum of ``columns`` are shuffled.
    """
    before = old.select(key, row_hash(old, columns).alias("_old"))
    after = new.select(key, row_hash(new, columns).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "new")
        .when(F.col("_new").isNull(), "gone")
        .when(F.col("_old") == F.col("_new"), "same")
        .otherwise("changed")
    )
    return before.join(after, key, "full_outer").select(key, change.alias("change"))


def normalised_street(street: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(street)), r"\s+", " ")


def cross_id_duplicates(table: DataFrame, key: str = "id") -> DataFrame:
    """Homes listed under several ids: equal normalised street, zip code and size.

    ``kept_id`` is the smallest id of the home. A home whose street, zip code or size
    is unknown equals no other.
    """
    place = [normalised_street(F.col("street")).alias("street_norm"), F.col("zip_code"), F.col("size")]
    # Distinct ids first: a home seen often is one row per id before it meets the others.
    ids = table.select(*place, key).dropna(subset=["street_norm", "zip_code", "size"]).distinct()
    return (
        ids.groupBy("street_norm", "zip_code", "size")
        .agg(F.count(F.lit(1)).alias("id_count"), F.min(key).alias("kept_id"))
        .filter("id_count > 1")
    )
