"""The queries over the smallest given tables, and the pipeline against its stages."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from hearthline.llm import decontamination, line_dedup, near_simhash, queries
from tools.check import normal

SMALL = Path("/root/testdata/sf0.001")
given = pytest.mark.skipif(not SMALL.exists(), reason="no given tables")


@given
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_its_sql(spark, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    want = normal(duck.sql(queries.ORACLES[name]).to_arrow_table().to_pandas())
    got = normal(queries.QUERIES[name](spark, str(SMALL)).toArrow().to_pandas())
    assert list(got.columns) == list(want.columns) and got.equals(want)


#: Queries over other tables than documents; test_structure_repair and test_whitening cover them.
OTHERS = {"op12_structure_repair", "op13_whitening"}


@given
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - OTHERS))
def test_covers_all_documents(spark, name):
    got = queries.QUERIES[name](spark, str(SMALL))
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    ids = got.select("doc_id").distinct().count()
    assert 0 < ids <= n if name == "op3_decontamination" else ids == n


@given
def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], str(SMALL)).write.parquet(f"{tmp_path}/{k}")
        seen.append(spark.read.parquet(f"{tmp_path}/{k}"))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert seen[-1].columns == docs.columns
    _, calm, lines, single, clean, packed = seen
    assert 0 < calm.count() <= docs.count() and lines.count() == calm.count()
    cut = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(calm, wide=True).collect()}
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == cut
    groups = near_simhash.near_duplicates(lines).select("component_id").distinct()
    assert {r["doc_id"] for r in single.collect()} == {r["component_id"] for r in groups.collect()}
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    leaking = {r["doc_id"] for r in decontamination.contaminated(single, bench).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in single.collect()} - leaking
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in clean.collect()}
    assert corpus_pipeline.run(spark, str(SMALL)).count() == packed.count()
