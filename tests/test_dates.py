from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from hearthline.functions.dates import days_back, iso_timestamp, seconds_between

TEXTS = [
    "2024-05-01", "20240501", "2024", "2024-05", "", "x", "2024-05-01T10:00:00Z", "2024-05-01Z",
    "2024-05-01T10:00:00+02:00", "2024-05-01T10:00:00.123456789-0130", "2024-02-30", "2023-02-29", "2024-02-29",
    "2024-05-01T24:30", "2024-05-01T23:59:60", "2024-05-01 1030", "2024-05-01T10:3015", "2024-0501", "0000-01-01",
    "2024-05-01T10:00:00,5", "20240501T101112+01", "2024-12-31T23:30:00-02:00", "2024-05-01T10", "2024-13-01",
    "2024-05-01T10:60", "2024-05-01T10:00:00+25:00", " 2024-05-01", "2024-05-01T",
]


def python_says(text):
    try:
        moment = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    return moment.astimezone(UTC).replace(tzinfo=None) if moment.tzinfo else moment


@pytest.mark.parametrize("zone", ["UTC", "Europe/Copenhagen"])
def test_iso_texts_as_in_python(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").selectExpr("t", f"{iso_timestamp('t')} AS m")
        assert rows.schema["m"].dataType.typeName() == "timestamp_ntz"
        assert {r.t: r.m for r in rows.collect()} == {t: python_says(t) for t in TEXTS}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_windows_and_seconds(spark):
    first, last = days_back("2024-03-01 10:00:00", 7)
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-01 00:00:00.9", "2024-01-02 00:00:01.1"))
    row = spark.range(1).select(first.alias("a"), last.alias("b"), seconds_between(start, end).alias("s")).first()
    assert (str(row.a), str(row.b), row.s) == ("2024-02-23", "2024-03-01", 86401)
