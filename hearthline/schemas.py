"""Stored tables: column order, types and keys."""

from __future__ import annotations

from pyspark.sql import types as T

METADATA = ("scraped_at", "updated_at", "version")

_METADATA_FIELDS = [
    T.StructField("scraped_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("version", T.IntegerType()),
]

ACTIVE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("price", T.IntegerType()),
        T.StructField("rooms", T.DoubleType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("lot_size", T.IntegerType()),
        T.StructField("build_year", T.IntegerType()),
        T.StructField("energy_class", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("zip_code", T.IntegerType()),
        T.StructField("street", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("days_for_sale", T.IntegerType()),
        T.StructField("created_date", T.TimestampNTZType()),
        T.StructField("property_type", T.IntegerType()),
    ]
    + _METADATA_FIELDS
)

SOLD = T.StructType(
    [
        T.StructField("estate_id", T.LongType()),
        T.StructField("address", T.StringType()),
        T.StructField("zip_code", T.IntegerType()),
        T.StructField("price", T.IntegerType()),
        T.StructField("sold_date", T.DateType()),
        T.StructField("property_type", T.IntegerType()),
        T.StructField("sale_type", T.StringType()),
        T.StructField("sqm_price", T.DoubleType()),
        T.StructField("rooms", T.DoubleType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("build_year", T.IntegerType()),
        T.StructField("change_percent", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("city", T.StringType()),
    ]
    + _METADATA_FIELDS
)

# Counters a run adds up, in ledger column order.
COUNTERS = (
    "records_processed",
    "records_inserted",
    "records_updated",
    "records_failed",
    "api_calls_made",
)

LEDGER = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("scrape_type", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("records_inserted", T.LongType()),
        T.StructField("records_updated", T.LongType()),
        T.StructField("records_failed", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("checkpoint_data", T.StringType()),
        T.StructField("api_calls_made", T.LongType()),
        T.StructField("total_pages", T.IntegerType()),
        T.StructField("current_page", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

# What a run writes while it works: one row per start, progress step and end.
# ``kind`` is start, delta or end; counters are increments, never totals.
LEDGER_EVENT = T.StructType(
    [
        T.StructField("session_id", T.LongType()),
        T.StructField("scrape_type", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("seq", T.LongType()),
        T.StructField("total_pages", T.IntegerType()),
        T.StructField("current_page", T.IntegerType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("records_inserted", T.LongType()),
        T.StructField("records_updated", T.LongType()),
        T.StructField("records_failed", T.LongType()),
        T.StructField("api_calls_made", T.LongType()),
        T.StructField("checkpoint_data", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)
