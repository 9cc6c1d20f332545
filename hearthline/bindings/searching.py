"""Figures and searches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.bindings.views import ORDER, Views, bound, sql
from hearthline.functions.dates import days_back, seconds_between
from hearthline.functions.scalars import megabytes, ratio, zero_if_null
from hearthline.operators import history, search, stats

HIT = ("id", *ORDER)
SOLD_AS_OF = "2001-06-30 12:00:00"


def _stats(name: str) -> tuple[Callable, str]:
    def run(view: Views) -> DataFrame:
        return stats.table_stats(view(name)).withColumn("avg_price", F.round("avg_price", 4))

    text = f"""SELECT count(*) AS total_count, min(price) AS min_price, max(price) AS max_price,
        round(avg(price), 4) AS avg_price, min(scraped_at) AS first_scraped, max(scraped_at) AS last_scraped FROM {name}"""
    return bound(run), sql(text, name)


def _active(where: str, **params) -> tuple[Callable, str]:
    def run(view: Views) -> DataFrame:
        return search.search_active(view("v_held"), **params).select(*HIT)

    return bound(run), sql(f"SELECT id, scraped_at, o1, o2, o3 FROM v_held WHERE {where}", "v_held")


def _sold(where: str, **params) -> tuple[Callable, str]:
    def run(view: Views) -> DataFrame:
        return search.search_sold(view("v_held_sold"), **params).select("estate_id", "price", "sold_date")

    return bound(run), sql(f"SELECT estate_id, price, sold_date FROM v_held_sold WHERE {where}", "v_held_sold")


def q6_search(view: Views) -> DataFrame:
    hits = view("v_held")
    developments = history.price_development(hits, "id", ORDER)
    return search.search_active(hits, developments, priceDevelopment="down", roomsMin=2).select(*HIT)


Q6_SQL = sql(
    """SELECT id, scraped_at, o1, o2, o3 FROM v_held WHERE rooms >= 2 AND id IN (
         SELECT id FROM (SELECT id, price, lag(price) OVER w AS old_price, lead(id) OVER w AS further
                         FROM v_held WINDOW w AS (PARTITION BY id ORDER BY scraped_at, o1, o2, o3))
         WHERE further IS NULL AND price < old_price)""",
    "v_held",
)


def q10(view: Views) -> DataFrame:
    return search.sold_since(view("v_held_sold"), SOLD_AS_OF, 365).select("estate_id", "price", "sold_date")


def t2_sold(view: Views) -> DataFrame:
    found = search.search_sold(view("v_held_sold"), priceMin=100_000)
    return search.sold_page(found, "date-d", page=4).select("estate_id", "sold_date", "price")


def t2_after(view: Views) -> DataFrame:
    """The page after a given row, found by value."""
    found = view("v_held_sold")
    return search.sold_page(found, "price-a", after=(250_000, 0)).select("estate_id", "price")


def _first_hits(view: Views) -> DataFrame:
    """One row per home: its smallest sighting."""
    hits = view("v_held")
    return hits.groupBy("id").agg(F.min_by(F.struct("days_for_sale", "price"), F.struct(*ORDER)).alias("r")).select(
        "id", "r.*"
    )


def f5(view: Views) -> DataFrame:
    first, last = days_back(F.col("o_orderdate"), 7)
    return view("orders").select("o_orderkey", first.alias("first_day"), last.alias("last_day"))


def f6(view: Views) -> DataFrame:
    return view("v_active").select(
        *HIT,
        zero_if_null(F.col("price")).alias("price_or_zero"),
        ratio(F.col("price"), F.col("size")).alias("price_per_size"),
    )


def f7(view: Views) -> DataFrame:
    return view("documents").select("doc_id", megabytes(F.octet_length("text") * 1000).alias("mb"))


def e3(view: Views) -> DataFrame:
    """The report's three parts, one row each: rows, and the sum that each part is about."""
    from hearthline.plans.jobs import report

    parts = report(view("v_held"), view("v_held_sold"), view("v_session"))
    runs = parts.runs.agg(F.sum("session_count").alias("rows"), F.sum("total_processed").cast("double").alias("figure"))
    told = runs.select(F.lit("runs").alias("part"), "rows", "figure")
    for name, stated in (("active", parts.active), ("sold", parts.sold)):
        told = told.unionByName(
            stated.select(F.lit(name).alias("part"), F.col("total_count").alias("rows"), F.round("avg_price", 4).alias("figure"))
        )
    return told


def _sorted(view: Views) -> DataFrame:
    return search.active_page(_first_hits(view), "daysForSale-a", page=3).select("id", "days_for_sale", "price")


BINDINGS = {
    "a1_active_stats": _stats("v_held"),
    "a2_sold_stats": _stats("v_held_sold"),
    "q1_search_active": _active(
        """price >= 20000 AND price <= 60000 AND rooms >= 2 AND rooms <= 6 AND size >= 10 AND size <= 45
           AND lot_size >= 1 AND build_year >= 1850 AND build_year <= 2000 AND days_for_sale <= 150""",
        priceMin=20_000, priceMax=60_000, roomsMin=2, roomsMax=6, sizeMin=10, sizeMax=45, lotSizeMin=1,
        buildYearMin=1850, buildYearMax=2000, daysForSaleMax=150,
    ),
    "q2_sqm_price": _active(
        "price / CAST(size AS DOUBLE) BETWEEN 1000 AND 2000", sqmPriceMin=1000, sqmPriceMax=2000
    ),
    "q3_energy_class": _active(
        "ascii(energy_class) <= ascii('N') AND ascii(energy_class) >= ascii('B')", energyClassMin="N", energyClassMax="B"
    ),
    "q4_property_type": _active("property_type = 2", propertyType=2),
    "q5_free_text": _active(
        "contains(lower(street), 'street 1') OR contains(lower(city), 'street 1')", q="STREET 1"
    ),
    "q6_price_down": (bound(q6_search), Q6_SQL),
    "q7_search_sold": _sold(
        """price >= 50000 AND price <= 300000 AND size >= 10 AND size <= 60 AND rooms >= 1 AND rooms <= 6
           AND build_year >= 1850 AND build_year <= 2010 AND zip_code >= 2000 AND zip_code <= 8000""",
        priceMin=50_000, priceMax=300_000, sizeMin=10, sizeMax=60, roomsMin=1, roomsMax=6, buildYearMin=1850,
        buildYearMax=2010, zipcodeFrom=2000, zipcodeTo=8000,
    ),
    "q8_sold_equality": _sold(
        "property_type = 3 AND sale_type = '2-HIGH' AND contains(lower(address), 'address 1')",
        propertyType=3, saleType="2-HIGH", street="Address 1",
    ),
    "q9_sold_since_year": _sold("sold_date >= DATE '1998-01-01'", salesDateMin="1998"),
    "q10_incremental": (
        bound(q10),
        sql(
            """SELECT estate_id, price, sold_date FROM v_held_sold
               WHERE sold_date BETWEEN DATE '2001-06-30' - INTERVAL 365 DAY AND DATE '2001-06-30'""",
            "v_held_sold",
        ),
    ),
    "q11_bounding_box": _active(
        "latitude BETWEEN 55 AND 56.5 AND longitude BETWEEN 8.2 AND 8.7",
        latitudeMin=55, latitudeMax=56.5, longitudeMin=8.2, longitudeMax=8.7,
    ),
    "q12_city_zip": _active("city = 'NATION_7'", city="NATION_7"),
    "q12_zip": _active("zip_code = 2390", zipCode=2390),
    "q11_sold_bounding_box": _sold(
        "latitude BETWEEN 55 AND 56.5 AND longitude BETWEEN 8.2 AND 9.7",
        latitudeMin=55, latitudeMax=56.5, longitudeMin=8.2, longitudeMax=9.7,
    ),
    "q12_sold_city": _sold("city = 'NATION_7'", city="NATION_7"),
    "q12_sold_zip": _sold("zip_code = 2165", zipCode=2165),
    "e3_report": (
        bound(e3),
        sql(
            """SELECT 'active' AS part, count(*) AS rows, round(avg(price), 4) AS figure FROM v_held
               UNION ALL SELECT 'sold', count(*), round(avg(price), 4) FROM v_held_sold
               UNION ALL SELECT 'runs', count(*), CAST(sum(records_processed) AS DOUBLE) FROM v_session""",
            "v_held",
            "v_held_sold",
            "v_session",
        ),
    ),
    "t2_active_page": (
        bound(_sorted),
        sql(
            """SELECT id, days_for_sale, price FROM (
                 SELECT *, row_number() OVER (PARTITION BY id ORDER BY scraped_at, o1, o2, o3) AS rn FROM v_held)
               WHERE rn = 1 ORDER BY days_for_sale, id LIMIT 50 OFFSET 150""",
            "v_held",
        ),
    ),
    "t2_sold_page": (
        bound(t2_sold),
        sql(
            """SELECT estate_id, sold_date, price FROM v_held_sold WHERE price >= 100000
               ORDER BY sold_date DESC, estate_id LIMIT 50 OFFSET 150""",
            "v_held_sold",
        ),
    ),
    "t2_page_after": (
        bound(t2_after),
        sql(
            """SELECT estate_id, price FROM v_held_sold WHERE price > 250000 OR (price = 250000 AND estate_id > 0)
               ORDER BY price, estate_id LIMIT 50""",
            "v_held_sold",
        ),
    ),
    "f5_days_back": (
        bound(f5),
        """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 7 DAY AS DATE) AS first_day,
                  CAST(o_orderdate AS DATE) AS last_day FROM orders""",
    ),
    "f5_seconds_between": (
        bound(
            lambda view: view("events").select(
                "event_id", seconds_between(F.lit("2024-01-01 00:00:00.9").cast("timestamp_ntz"), F.col("ts")).alias("seconds")
            )
        ),
        """SELECT event_id, CAST(epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '2024-01-01 00:00:00') AS BIGINT) AS seconds
           FROM events""",
    ),
    "f6_null_and_ratio": (
        bound(f6),
        sql(
            """SELECT id, scraped_at, o1, o2, o3, coalesce(price, 0) AS price_or_zero,
                      price / CAST(greatest(size, 1) AS DOUBLE) AS price_per_size FROM v_active""",
            "v_active",
        ),
    ),
    "f7_megabytes": (
        bound(f7),
        "SELECT doc_id, round(octet_length(encode(text)) * 1000 / 1048576e0, 2) AS mb FROM documents",
    ),
}
