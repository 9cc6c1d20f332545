"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Property type codes of the source.
PROPERTY_TYPES = {1: "house", 2: "apartment", 3: "townhouse", 4: "villa", 99: "other"}

# Texts in an error message that mark it worth another attempt.
RETRYABLE = ("timeout", "server error")

MAX_ATTEMPTS = 3
RETRY_DELAY_SECONDS = 1.0
BYTES_PER_MB = 1024 * 1024


def type_name(code: Column) -> Column:
    """Name of a property type code; NULL for a code the source does not define."""
    named = F.lit(None).cast("string")
    for number, name in PROPERTY_TYPES.items():
        named = F.when(code == number, name).otherwise(named)
    return named


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def ratio(part: Column, whole: Column) -> Column:
    """part / max(whole, 1)."""
    return part / F.greatest(whole, F.lit(1))


def megabytes(size_bytes: Column) -> Column:
    """Bytes to MB with two decimals."""
    return F.round(size_bytes / F.lit(BYTES_PER_MB), 2)


def checksum(*columns: Column | str) -> Column:
    """SHA-256 hex of a row's named values, written as JSON without NULLs."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def is_retryable(message: Column) -> Column:
    lowered = F.lower(F.coalesce(message, F.lit("")))
    found = F.lit(False)
    for text in RETRYABLE:
        found = found | lowered.contains(text)
    return found


def should_retry(message: Column, attempt: Column, max_attempts: int = MAX_ATTEMPTS) -> Column:
    """Another attempt after ``attempt`` failed ones (counted from 0)."""
    return (attempt < max_attempts) & is_retryable(message)


def retry_wait(attempt: Column, delay: float = RETRY_DELAY_SECONDS) -> Column:
    """Seconds to wait before the next attempt."""
    return F.lit(float(delay)) * (attempt + 1)


def write_checkpoint(*columns: Column | str) -> Column:
    """Checkpoint fields as JSON text, NULL fields kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def read_checkpoint(text: Column, field: str, kind: str = "string") -> Column:
    """One field of a checkpoint JSON text; NULL if text or field is unusable."""
    return F.try_variant_get(F.try_parse_json(text), f"$.{field}", kind)
