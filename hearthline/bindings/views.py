"""The given tables seen as property data, in SQL both engines read alike."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-06-30 12:00:00"
EARLIER = "2024-06-01 12:00:00"
YEAR = 2024
CUT = "1998-01-01"
ORDER = ("scraped_at", "o1", "o2", "o3")

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# View -> (views it needs, text).
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    # Repeated sightings of homes for sale: keys repeat, some rows are bad.
    "v_active": (
        (),
        """
SELECT l_orderkey AS id,
       CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE CAST(floor(l_extendedprice) AS INT) END AS price,
       CAST(l_linenumber AS DOUBLE) AS rooms,
       CAST(floor(l_quantity) AS INT) - 1 AS size,
       CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(l_partkey AS INT) END AS lot_size,
       CAST(1790 + l_partkey % 250 AS INT) AS build_year,
       l_returnflag AS energy_class,
       n_name AS city,
       CAST(990 + (l_partkey * 7) % 9020 AS INT) AS zip_code,
       concat('Street ', l_suppkey) AS street,
       54.5e0 + CAST(l_partkey % 300 AS DOUBLE) / 1e2 AS latitude,
       8e0 + CAST(l_suppkey % 700 AS DOUBLE) / 1e2 AS longitude,
       CAST(l_linenumber * 30 - 20 AS INT) AS days_for_sale,
       l_shipdate AS created_date,
       CAST(1 + l_linenumber % 5 AS INT) AS property_type,
       l_shipdate AS scraped_at,
       l_shipdate AS updated_at,
       1 AS version,
       l_linenumber AS o1, l_partkey AS o2, l_suppkey AS o3
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation ON s_nationkey = n_nationkey""",
    ),
    # Sightings the store can hold.
    "v_held": (
        ("v_active",),
        """
SELECT * FROM v_active
WHERE price > 0 AND (rooms IS NULL OR rooms >= 0) AND (size IS NULL OR size > 0)
  AND zip_code BETWEEN 1000 AND 9999
  AND (build_year IS NULL OR build_year BETWEEN 1800 AND 2030)
  AND (latitude IS NULL OR latitude BETWEEN -90 AND 90)
  AND (longitude IS NULL OR longitude BETWEEN -180 AND 180)
  AND (days_for_sale IS NULL OR days_for_sale >= 0)
  AND id IS NOT NULL AND city IS NOT NULL AND street IS NOT NULL""",
    ),
    # Sales, one row per key, some rows bad.
    "v_sold": (
        (),
        """
SELECT o_orderkey AS estate_id,
       concat('Address ', o_custkey) AS address,
       CAST(995 + (o_custkey * 13) % 9010 AS INT) AS zip_code,
       CAST(floor(o_totalprice) AS INT) AS price,
       CAST(o_orderdate AS DATE) AS sold_date,
       CAST(1 + o_custkey % 4 AS INT) AS property_type,
       o_orderpriority AS sale_type,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice / 1e2 END AS sqm_price,
       CAST(o_custkey % 8 AS DOUBLE) AS rooms,
       CAST(floor(o_totalprice / 5e3) AS INT) AS size,
       CAST(1795 + o_custkey % 240 AS INT) AS build_year,
       c_acctbal / 1e2 AS change_percent,
       CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE 54e0 + CAST(o_custkey % 400 AS DOUBLE) / 1e2 END AS latitude,
       8e0 + CAST(o_custkey % 700 AS DOUBLE) / 1e2 AS longitude,
       n_name AS city,
       o_orderdate AS scraped_at,
       o_orderdate AS updated_at,
       1 AS version
FROM orders JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "v_held_sold": (
        ("v_sold",),
        """
SELECT * FROM v_sold
WHERE price > 0 AND zip_code BETWEEN 1000 AND 9999
  AND (sqm_price IS NULL OR sqm_price >= 0) AND (rooms IS NULL OR rooms >= 0)
  AND (size IS NULL OR size > 0)
  AND (build_year IS NULL OR build_year BETWEEN 1800 AND 2030)
  AND (latitude IS NULL OR latitude BETWEEN -90 AND 90)
  AND (longitude IS NULL OR longitude BETWEEN -180 AND 180)
  AND estate_id IS NOT NULL AND address IS NOT NULL AND sold_date IS NOT NULL AND city IS NOT NULL""",
    ),
    # Raw listings with a fault for every rule.
    "v_listing": (
        (),
        """
SELECT l_orderkey AS id,
       CASE WHEN l_suppkey % 17 = 0 THEN NULL
            WHEN l_partkey % 23 = 0 THEN -1 ELSE CAST(floor(l_extendedprice) AS INT) END AS price,
       CAST(l_linenumber - 2 AS DOUBLE) AS rooms,
       CAST(floor(l_quantity) AS INT) - 1 AS size,
       CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(l_partkey AS INT) END AS lot_size,
       CAST(1790 + l_partkey % 250 AS INT) AS build_year,
       l_returnflag AS energy_class,
       CASE WHEN l_suppkey % 29 = 0 THEN NULL ELSE n_name END AS city,
       CAST(990 + (l_partkey * 7) % 9020 AS INT) AS zip_code,
       concat('Street ', l_suppkey) AS street,
       54.5e0 + CAST(l_partkey % 80 AS DOUBLE) / 2e0 AS latitude,
       8e0 + CAST(l_suppkey % 80 AS DOUBLE) * 2.5e0 AS longitude,
       CAST(l_linenumber * 30 - 50 AS INT) AS days_for_sale,
       CASE l_linenumber WHEN 1 THEN '2024-05-01T10:00:00Z' WHEN 2 THEN '' WHEN 3 THEN '2024'
            WHEN 4 THEN '20240501' WHEN 5 THEN '2024-02-30' WHEN 6 THEN '2024-05-01T10:00:00+02:00'
            ELSE NULL END AS created_text,
       CAST(1 + l_linenumber % 5 AS INT) AS property_type,
       CAST(floor(l_orderkey / 50) AS BIGINT) AS page,
       l_shipdate AS scraped_at,
       l_linenumber AS o1, l_partkey AS o2, l_suppkey AS o3
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation ON s_nationkey = n_nationkey""",
    ),
    # Raw sales with faults.
    "v_sale": (
        (),
        """
SELECT o_orderkey AS estate_id,
       CASE WHEN o_custkey % 31 = 0 THEN NULL ELSE concat('Address ', o_custkey) END AS address,
       CAST(995 + (o_custkey * 13) % 9010 AS INT) AS zip_code,
       CAST(floor(o_totalprice) AS INT) AS price,
       CASE o_orderpriority WHEN '1-URGENT' THEN '2024-05' WHEN '5-LOW' THEN ''
            ELSE concat(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), 'T23:30:00-02:00') END AS sold_text,
       CAST(1 + o_custkey % 4 AS INT) AS property_type,
       o_orderpriority AS sale_type,
       CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN CAST(-1 AS INT)
            ELSE CAST(floor(o_totalprice / 1e2) AS INT) END AS sqm_price,
       CAST(o_custkey % 8 AS INT) - 1 AS rooms,
       CAST(floor(o_totalprice / 5e3) AS INT) AS size,
       CAST(1795 + o_custkey % 240 AS INT) AS build_year,
       CAST(floor(c_acctbal) AS INT) AS change_percent,
       CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE CAST(54 + o_custkey % 40 AS INT) END AS latitude,
       CAST(8 + o_custkey % 180 AS INT) AS longitude,
       n_name AS city,
       CAST(1 + floor(o_orderkey / 50) AS BIGINT) AS page,
       o_orderdate AS day
FROM orders JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey""",
    ),
    # One progress step per event.
    "v_progress": (
        (),
        """
SELECT user_id * 100 + extract(day FROM ts) AS session_id,
       CASE WHEN user_id % 2 = 0 THEN 'active' ELSE 'sold' END AS scrape_type,
       ts AS updated_at, event_id,
       CAST(floor(value) AS INT) AS current_page,
       CAST(1 AS BIGINT) AS records_processed,
       CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS records_inserted,
       CAST(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS BIGINT) AS records_updated,
       CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS records_failed,
       CAST(1 AS BIGINT) AS api_calls_made,
       props AS checkpoint_data
FROM events""",
    ),
    # The ledger those steps amount to.
    "v_session": (
        ("v_progress",),
        """
SELECT session_id AS id, scrape_type,
       min(updated_at) AS start_time,
       CASE WHEN sum(records_failed) = 1 THEN NULL ELSE max(updated_at) END AS end_time,
       CASE WHEN sum(records_failed) = 0 THEN 'completed'
            WHEN sum(records_failed) = 1 THEN 'running' ELSE 'failed' END AS status,
       CAST(sum(records_processed) AS BIGINT) AS records_processed,
       CAST(sum(records_inserted) AS BIGINT) AS records_inserted,
       CAST(sum(records_updated) AS BIGINT) AS records_updated,
       CAST(sum(records_failed) AS BIGINT) AS records_failed,
       CAST(sum(api_calls_made) AS BIGINT) AS api_calls_made,
       CASE WHEN sum(records_failed) = 2 THEN 'Request Timeout on page'
            WHEN sum(records_failed) = 3 THEN 'Internal server error'
            WHEN sum(records_failed) > 3 THEN 'bad request' ELSE NULL END AS error_message,
       max(current_page) AS current_page,
       CAST(200 AS INT) AS total_pages,
       max(updated_at) AS updated_at
FROM v_progress GROUP BY session_id, scrape_type""",
    ),
}


def _needed(names: tuple[str, ...]) -> list[str]:
    found: list[str] = []
    for name in names:
        for wanted in (*_needed(VIEWS[name][0]), name):
            if wanted not in found:
                found.append(wanted)
    return found


def sql(body: str, *views: str, **more: str) -> str:
    """``body`` with the views and further named subqueries in front."""
    parts = [f"{name} AS ({VIEWS[name][1].strip()})" for name in _needed(views)]
    parts += [f"{name} AS ({text.strip()})" for name, text in more.items()]
    return f"WITH {', '.join(parts)} {body.strip()}" if parts else body.strip()


Views = Callable[[str], DataFrame]


def opened(spark: SparkSession, folder: str) -> Views:
    """A function from table or view name to its frame."""

    @cache
    def view(name: str) -> DataFrame:
        if name in TABLES:
            return spark.read.parquet(f"{folder}/{name}.parquet")
        words = VIEWS[name][1].split()
        for needed in (*[t for t in TABLES if t in words], *VIEWS[name][0]):
            view(needed).createOrReplaceTempView(needed)
        return spark.sql(VIEWS[name][1])

    return view


def bound(query: Callable[[Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(opened(spark, folder))
