"""Constraints of the stored tables.

A breach list is empty for a row the table can hold. As with SQL CHECKs a NULL
passes a range; NOT NULL is a rule of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_NULL_ACTIVE = ("id", "price", "city", "zip_code", "street", "scraped_at", "updated_at", "version")
NOT_NULL_SOLD = (
    "estate_id",
    "address",
    "zip_code",
    "price",
    "sold_date",
    "city",
    "scraped_at",
    "updated_at",
    "version",
)

_SHARED = {
    "price > 0": "price > 0",
    "rooms >= 0": "rooms >= 0",
    "size > 0": "size > 0",
    "zip_code 1000..9999": "zip_code BETWEEN 1000 AND 9999",
    "build_year 1800..2030": "build_year BETWEEN 1800 AND 2030",
    "latitude -90..90": "latitude BETWEEN -90 AND 90",
    "longitude -180..180": "longitude BETWEEN -180 AND 180",
}
CHECKS_ACTIVE = {**_SHARED, "days_for_sale >= 0": "days_for_sale >= 0"}
CHECKS_SOLD = {**_SHARED, "sqm_price >= 0": "sqm_price >= 0"}


def _breaches(not_null: Sequence[str], checks: dict[str, str]) -> Column:
    broken = [f"CASE WHEN {c} IS NULL THEN '{c} not null' END" for c in not_null]
    broken += [f"CASE WHEN NOT ({holds}) THEN '{name}' END" for name, holds in checks.items()]
    return F.expr(f"filter(array({', '.join(broken)}), b -> b IS NOT NULL)")


def breaches_active() -> Column:
    """Names of the constraints an active row breaks."""
    return _breaches(NOT_NULL_ACTIVE, CHECKS_ACTIVE)


def breaches_sold() -> Column:
    """Names of the constraints a sold row breaks."""
    return _breaches(NOT_NULL_SOLD, CHECKS_SOLD)


def _storable(not_null: Sequence[str], checks: dict[str, str]) -> Column:
    passes = [f"{c} IS NOT NULL" for c in not_null] + [f"coalesce({holds}, true)" for holds in checks.values()]
    return F.expr(" AND ".join(passes))


def storable_active() -> Column:
    """True where :func:`breaches_active` is empty, as one condition."""
    return _storable(NOT_NULL_ACTIVE, CHECKS_ACTIVE)


def storable_sold() -> Column:
    return _storable(NOT_NULL_SOLD, CHECKS_SOLD)


def key_breaches(table: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row."""
    return table.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
