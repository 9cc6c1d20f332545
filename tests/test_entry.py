"""Queries and their SQL over the smallest given tables, if they are there."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from hearthline.bindings.views import TABLES
from tools.check import normal

SMALL = Path("/root/testdata/sf0.001")
SOME = (
    "a1_active_stats", "a2_sold_stats", "w1_upsert", "w1_upsert_stats", "n1_dedup_latest", "n5_version_history",
    "a8_fold_ledger", "a3_run_stats", "s6_missing_pages", "v3_price", "a5_validation_summary", "q1_search_active",
    "t2_sold_page", "w4_refresh_diff", "w5_cross_id_duplicates",
)


def test_every_key_is_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.queries()) - set(entry.oracle_sql()) - set(entry.LLM_QUERIES) == {"s12_dataset_size"}


@pytest.mark.skipif(not SMALL.exists(), reason="no given tables")
@pytest.mark.parametrize("name", SOME)
def test_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    want = normal(duck.sql(entry.oracle_sql()[name]).to_arrow_table().to_pandas())
    got = normal(entry.queries()[name](spark, str(SMALL)).toArrow().to_pandas())
    assert list(got.columns) == list(want.columns) and got.equals(want)


@pytest.mark.skipif(not SMALL.exists(), reason="no given tables")
def test_flagship(spark):
    assert entry.entry(spark).first().total_count > 0
