"""From raw records to table rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthline import schemas
from hearthline.functions.dates import iso_timestamp, ntz
from hearthline.functions.variants import kind as kind_of
from hearthline.functions.variants import text, typed, values

# (record key, table column, how it is read). Whole numbers are cut toward zero.
ACTIVE_FIELDS = (
    ("id", "id", "bigint"),
    ("price", "price", "int"),
    ("rooms", "rooms", "double"),
    ("size", "size", "int"),
    ("lotSize", "lot_size", "int"),
    ("buildYear", "build_year", "int"),
    ("energyClass", "energy_class", "string"),
    ("city", "city", "string"),
    ("zipCode", "zip_code", "int"),
    ("street", "street", "string"),
    ("latitude", "latitude", "double"),
    ("longitude", "longitude", "double"),
    ("daysForSale", "days_for_sale", "int"),
    ("createdDate", "created_date", "iso timestamp"),
    ("propertyType", "property_type", "int"),
)

SOLD_FIELDS = (
    ("estateId", "estate_id", "bigint"),
    ("address", "address", "string"),
    ("zipCode", "zip_code", "int"),
    ("price", "price", "int"),
    ("soldDate", "sold_date", "iso date"),
    ("propertyType", "property_type", "int"),
    ("saleType", "sale_type", "string"),
    ("sqmPrice", "sqm_price", "double"),
    ("rooms", "rooms", "double"),
    ("size", "size", "int"),
    ("buildYear", "build_year", "int"),
    ("change", "change_percent", "double"),
    ("latitude", "latitude", "double"),
    ("longitude", "longitude", "double"),
    ("city", "city", "string"),
)

REQUIRED_ACTIVE = ("id", "price", "size", "city", "zip_code", "street")
REQUIRED_SOLD = ("estate_id", "address", "zip_code", "price", "sold_date", "city")


def _looked(items: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """``items`` with ``_raw``, the fields' values, and ``_told``, the kinds of numbers and the texts of dates.

    Both are generated columns: a record is walked once, and what follows does not repeat it.
    """
    raw = items.selectExpr("*", f"explode(array({values([key for key, _ in fields])})) AS _raw")
    told = ", ".join(
        f"'{key}', {text(f'_raw.`{key}`') if kind.startswith('iso') else kind_of(f'_raw.`{key}`')}"
        for key, kind in fields
        if kind != "string"
    )
    return raw.selectExpr("*", f"explode(array(named_struct({told}))) AS _told")


def _value(key: str, kind: str) -> str:
    """A field of :func:`_looked` read as ``kind``."""
    told = f"_told.`{key}`"
    if kind == "iso timestamp":
        return iso_timestamp(told)
    if kind == "iso date":
        return f"CAST({iso_timestamp(told)} AS DATE)"
    return typed(f"_raw.`{key}`", told, kind)


def cleaned(items: DataFrame, fields: Sequence[tuple[str, str, str]], *keep: str) -> DataFrame:
    """The record's fields, typed, under their own keys.

    Fields no rule looks at pass through as they are.
    """
    return _looked(items, [(key, kind) for key, _, kind in fields]).select(*keep, *[F.expr(f"{_value(key, kind)} AS {key}") for key, _, kind in fields])


def _mapped(
    items: DataFrame,
    fields: Sequence[tuple[str, str, str]],
    as_of: datetime | str | Column,
    keep: Sequence[str | Column],
) -> DataFrame:
    now = ntz(as_of)
    return _looked(items, [(key, kind) for key, _, kind in fields]).select(
        *keep,
        *[F.expr(f"{_value(key, kind)} AS {column}") for key, column, kind in fields],
        now.alias("scraped_at"),
        now.alias("updated_at"),
        F.expr("1 AS version"),
    )


def map_active(items: DataFrame, as_of: datetime | str | Column, *keep: str) -> DataFrame:
    """Records of homes for sale as table rows, version 1, seen at ``as_of``."""
    return _mapped(items, ACTIVE_FIELDS, as_of, keep)


def map_sold(items: DataFrame, as_of: datetime | str | Column, *keep: str) -> DataFrame:
    """Records of sales as table rows, version 1, seen at ``as_of``."""
    return _mapped(items, SOLD_FIELDS, as_of, keep)


def from_snake(
    rows: DataFrame, schema: StructType, required: Sequence[str], as_of: datetime | str | Column, *keep: str
) -> DataFrame:
    """Rows that already use table column names, completed to the whole table.

    Missing optional columns are NULL, missing metadata is ``as_of`` and version
    1. ``change`` is read for ``change_percent``. A missing required column is an
    error of the whole frame: for records of which some lack a key, see
    :func:`snake_records`.
    """
    if "change_percent" in schema.names and "change" in rows.columns and "change_percent" not in rows.columns:
        rows = rows.withColumnRenamed("change", "change_percent")
    absent = [c for c in required if c not in rows.columns]
    if absent:
        raise ValueError(f"rows lack required columns: {', '.join(absent)}")
    default = {"scraped_at": ntz(as_of), "updated_at": ntz(as_of), "version": F.lit(1)}
    columns = []
    for field in schema:
        value = F.col(field.name) if field.name in rows.columns else F.lit(None)
        if field.name in default:
            value = F.coalesce(value.cast(field.dataType), default[field.name])
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*keep, *columns)


def lacking(required: Sequence[str], raw: str = "_raw") -> Column:
    """The required keys that are absent among the values of a record; a null is a value."""
    absent = [f"CASE WHEN {raw}.`{c}` IS NULL THEN '{c}' END" for c in required]
    return F.expr(f"array_compact(array({', '.join(absent)}))")


def lacking_records(items: DataFrame, required: Sequence[str]) -> DataFrame:
    """``missing`` of :func:`snake_records` for the records that lack a required key; nothing else is read."""
    raw = items.selectExpr(f"explode(array({values(required)})) AS _raw")
    told = raw.select(F.explode(F.array(lacking(required))).alias("missing"))
    return told.filter("size(missing) > 0")


def snake_records(
    items: DataFrame, schema: StructType, required: Sequence[str], as_of: datetime | str | Column, *keep: str
) -> DataFrame:
    """Records (VARIANT ``item``) that use table column names, as whole rows of the table, with ``missing``.

    ``missing`` lists the required keys a record lacks: such a record cannot be a row and counts
    as failed. As in :func:`from_snake`, missing optional keys are NULL, missing metadata is
    ``as_of`` and version 1, and ``change`` is read for ``change_percent``. What stands under a
    key but is not of its column's type is NULL.
    """
    now = {"scraped_at": ntz(as_of), "updated_at": ntz(as_of), "version": F.lit(1)}
    dates = {"timestamp_ntz": "iso timestamp", "date": "iso date"}
    fields = []
    for field in schema:
        kind = field.dataType.simpleString()
        fields.append(("change" if field.name == "change_percent" else field.name, dates.get(kind, kind)))
    known = {key for key, _ in fields}
    looked = _looked(items, fields + [(c, "string") for c in required if c not in known])
    looked = looked.select("*", F.explode(F.array(lacking(required))).alias("_missing"))
    columns = []
    for field, (key, kind) in zip(schema, fields):
        value = F.expr(_value(key, kind))
        if field.name in now:
            value = F.when(F.col(f"_raw.`{key}`").isNotNull(), value).otherwise(now[field.name])
        columns.append(value.cast(field.dataType).alias(field.name))
    return looked.select(*keep, *columns, F.col("_missing").alias("missing"))


def quick_map(items: DataFrame, as_of: datetime | str | Column, *keep: str) -> DataFrame:
    """The short mapping of a home for sale: eleven fields, city and street
    'Unknown' and zip code 0 where the key is absent (a null stays null)."""
    defaults = {"city": "'Unknown'", "zipCode": "0", "street": "'Unknown'"}
    wanted = ("id", "price", "rooms", "size", "city", "zipCode", "street", "latitude", "longitude", "buildYear",
              "propertyType")
    fields = [(key, column, kind) for key, column, kind in ACTIVE_FIELDS if key in wanted]
    columns = []
    for key, column, kind in fields:
        value = _value(key, kind)
        if key in defaults:
            value = f"CASE WHEN _raw.`{key}` IS NULL THEN {defaults[key]} ELSE {value} END"
        columns.append(F.expr(f"{value} AS {column}"))
    rows = _looked(items, [(key, kind) for key, _, kind in fields]).select(*keep, *columns)
    return from_snake(rows, schemas.ACTIVE, REQUIRED_ACTIVE, as_of, *keep)
