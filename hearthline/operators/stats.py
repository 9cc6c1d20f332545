"""Figures over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_stats(table: DataFrame) -> DataFrame:
    """Rows, price range and average, first and last time seen."""
    return table.agg(
        F.count(F.lit(1)).alias("total_count"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("price").alias("avg_price"),
        F.min("scraped_at").alias("first_scraped"),
        F.max("scraped_at").alias("last_scraped"),
    )


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("row_count"))
