"""Frames and SQL several bindings share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.bindings.views import AS_OF, CUT, EARLIER, ORDER, Views
from hearthline.operators import merge
from hearthline.plans.feeds import ACTIVE, SOLD, Feed

ACTIVE_ORDER = ORDER
SOLD_ORDER = ("scraped_at", "estate_id")
HIT = ("id", *ORDER)

_LISTING = (
    ("id", "id"), ("price", "price"), ("rooms", "rooms"), ("size", "size"), ("lot_size", "lotSize"),
    ("build_year", "buildYear"), ("energy_class", "energyClass"), ("city", "city"), ("zip_code", "zipCode"),
    ("street", "street"), ("latitude", "latitude"), ("longitude", "longitude"),
    ("days_for_sale", "daysForSale"), ("created_text", "createdDate"), ("property_type", "propertyType"),
)
_SALE = (
    ("estate_id", "estateId"), ("address", "address"), ("zip_code", "zipCode"), ("price", "price"),
    ("sold_text", "soldDate"), ("property_type", "propertyType"), ("sale_type", "saleType"),
    ("sqm_price", "sqmPrice"), ("rooms", "rooms"), ("size", "size"), ("build_year", "buildYear"),
    ("change_percent", "change"), ("latitude", "latitude"), ("longitude", "longitude"), ("city", "city"),
)
KEEP_NULLS = {"ignoreNullFields": "false"}


def record(names: tuple[tuple[str, str], ...], **instead: Column) -> Column:
    return F.struct(*[instead.get(column, F.col(column)).alias(key) for column, key in names])


def settled(value: Column) -> Column:
    """``value`` as a generated column: later filters on it stay above it, so the
    long expression that makes it is not copied into them."""
    return F.explode(F.array(value))


def written(column: str) -> Column:
    """A number with a fraction as it stands in JSON text: by its decimal digits."""
    return F.col(column).cast("decimal(38, 18)")


def listing_items(view: Views) -> DataFrame:
    """v_listing as raw records; nulls stay nulls."""
    fractions = {column: written(column) for column in ("rooms", "latitude", "longitude")}
    item = F.to_variant_object(record(_LISTING, **fractions))
    return view("v_listing").select("page", *HIT, settled(item).alias("item"))


def sparse_listing_items(view: Views) -> DataFrame:
    """v_listing as raw records; nulls are absent keys."""
    return view("v_listing").select("page", *HIT, settled(F.try_parse_json(F.to_json(record(_LISTING)))).alias("item"))


def sale_items(view: Views) -> DataFrame:
    item = F.to_variant_object(record(_SALE))
    return view("v_sale").select("page", "day", F.col("estate_id").alias("sale"), settled(item).alias("item"))


def listing_pages(view: Views) -> DataFrame:
    """A page per sighting, holding the listing and the same one re-priced; both
    spellings of the envelope occur."""
    again = record(_LISTING, price=F.col("price") + 1000)
    found = F.array(record(_LISTING), again)
    documented = F.struct(
        F.struct(F.col("o2").alias("totalCount"), F.col("page").alias("pageIndex"), F.lit(25).alias("pageSize")).alias(
            "meta"
        ),
        found.alias("results"),
    )
    coded = F.struct(
        F.struct(F.col("o2").alias("totalResults"), F.col("page").alias("pageIndex")).alias("meta"),
        found.alias("searchResults"),
    )
    body = F.when(F.col("o1") % 2 == 0, F.to_json(documented, KEEP_NULLS)).otherwise(F.to_json(coded, KEEP_NULLS))
    return view("v_listing").select(F.col("id").alias("home"), *ORDER, settled(body).alias("body"))


def sale_pages(view: Views) -> DataFrame:
    meta = F.struct(F.col("estate_id").alias("totalCount"), F.col("page").alias("pageIndex"))
    body = F.to_json(F.struct(meta.alias("meta"), F.array(record(_SALE)).alias("results")), KEEP_NULLS)
    return view("v_sale").select("day", settled(body).alias("body"))


def empty(view: Views, feed: Feed) -> DataFrame:
    frame = view("v_active" if feed is ACTIVE else "v_sold")
    return frame.select(*[F.col(f.name).cast(f.dataType) for f in feed.schema]).limit(0)


def before(frame: DataFrame) -> DataFrame:
    return frame.filter(F.col("scraped_at") < F.lit(CUT).cast("timestamp_ntz"))


def after(frame: DataFrame) -> DataFrame:
    return frame.filter(F.col("scraped_at") >= F.lit(CUT).cast("timestamp_ntz"))


def active_table(view: Views) -> DataFrame:
    """The table after the sightings before the cut."""
    return merge.upsert(empty(view, ACTIVE), before(view("v_active")), ACTIVE, ACTIVE_ORDER, EARLIER).table


def sold_table(view: Views) -> DataFrame:
    return merge.upsert(empty(view, SOLD), before(view("v_sold")), SOLD, SOLD_ORDER, EARLIER).table


def folded_sql(source: str, feed: Feed, order: tuple[str, ...]) -> str:
    """Per key: count, last payload, first metadata."""
    by = ", ".join(order)
    payload = ", ".join(f"l.{c}" for c in feed.payload)
    numbered = (
        f"SELECT *, row_number() OVER (PARTITION BY {feed.key} ORDER BY {by}) AS rn, "
        f"count(*) OVER (PARTITION BY {feed.key}) AS n FROM {source}"
    )
    return (
        f"SELECT l.{feed.key}, {payload}, f.scraped_at AS first_seen, f.updated_at AS first_updated, "
        f"f.version AS first_version, l.n FROM ({numbered}) l JOIN ({numbered}) f "
        f"ON l.{feed.key} = f.{feed.key} AND f.rn = 1 WHERE l.rn = l.n"
    )


def inserted_sql(folded: str, feed: Feed, as_of: str) -> str:
    """The table a first batch makes."""
    payload = ", ".join(feed.payload)
    return (
        f"SELECT {feed.key}, {payload}, first_seen AS scraped_at, "
        f"CASE WHEN n > 1 THEN TIMESTAMP '{as_of}' ELSE first_updated END AS updated_at, "
        f"CAST(first_version + n - 1 AS INT) AS version FROM {folded}"
    )


def merged_sql(table: str, folded: str, feed: Feed, as_of: str) -> str:
    """The table after a further batch."""
    k = feed.key
    payload = ", ".join(f"CASE WHEN g.{k} IS NULL THEN t.{c} ELSE g.{c} END AS {c}" for c in feed.payload)
    return (
        f"SELECT coalesce(t.{k}, g.{k}) AS {k}, {payload}, "
        f"CASE WHEN t.{k} IS NULL THEN g.first_seen ELSE t.scraped_at END AS scraped_at, "
        f"CASE WHEN g.{k} IS NULL THEN t.updated_at WHEN t.{k} IS NOT NULL OR g.n > 1 "
        f"THEN TIMESTAMP '{as_of}' ELSE g.first_updated END AS updated_at, "
        f"CAST(CASE WHEN g.{k} IS NULL THEN t.version WHEN t.{k} IS NOT NULL THEN t.version + g.n "
        f"ELSE g.first_version + g.n - 1 END AS INT) AS version "
        f"FROM {table} t FULL JOIN {folded} g ON t.{k} = g.{k}"
    )


def tables_sql(feed: Feed) -> dict[str, str]:
    """Subqueries old (the table before the cut) and fresh (the folded rest)."""
    held = "v_held" if feed is ACTIVE else "v_held_sold"
    order = ACTIVE_ORDER if feed is ACTIVE else SOLD_ORDER
    return {
        "early": f"SELECT * FROM {held} WHERE scraped_at < TIMESTAMP '{CUT}'",
        "late": f"SELECT * FROM {held} WHERE scraped_at >= TIMESTAMP '{CUT}'",
        "first_fold": folded_sql("early", feed, order),
        "old": inserted_sql("first_fold", feed, EARLIER),
        "fresh": folded_sql("late", feed, order),
        "merged": merged_sql("old", "fresh", feed, AS_OF),
    }
