"""Whitening against numpy's eigenvectors and whole-number sums."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest

from hearthline.llm import queries, whitening

SMALL = Path("/root/testdata/sf0.001")
SCHEMA = "vec_id long, embedding array<float>, component int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(3)


def matrices():
    rng = np.random.default_rng(4)
    for size, values in (
        (40, rng.random(40) * 100), (24, np.repeat([9.0, 4.0, 4.0 + 1e-9, 1.0], 6)), (6, np.ones(6)), (1, np.ones(1)),
        (30, np.r_[rng.random(5), np.zeros(25)]), (12, -rng.random(12)), (3, np.zeros(3)),
    ):
        basis = np.linalg.qr(rng.standard_normal((size, size)))[0]
        yield basis @ np.diag(values) @ basis.T


@pytest.mark.parametrize("matrix", list(matrices()), ids=range(7))
def test_eigenvectors(matrix):
    matrix = (matrix + matrix.T) / 2
    want = np.linalg.eigvalsh(matrix)[::-1][:16]
    values, vectors = whitening.leading(matrix, 16)
    scale = np.abs(want).max(initial=0) + 1e-300
    assert np.abs(values - want).max() <= 1e-13 * scale + 1e-300
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() <= 1e-13 * scale + 1e-300
    for shift in (want[0] + 0.5, want.mean() + 0.1234 * scale, want[-1] - 0.5):
        assert whitening.count_above(matrix, shift) == (np.linalg.eigvalsh(matrix) > shift).sum()


def check(got, rows, components=32):
    """Against exact sums and numpy's eigenvectors."""
    longest = max(len(v) for _, v in rows)
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in [*v, *[0.0] * (longest - len(v))]] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    spread = [[n * a - s for a, s in zip(row, sums)] for row in x]
    centred = np.array(spread, float) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    keep = values > 1e-12 * values[0]
    values, vectors = values[keep], vectors[:, keep]
    assert len(got) == n * len(values)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    expected = centred @ vectors / np.sqrt(values)
    for k, (name, _) in enumerate(rows):
        assert set(by[name]) == set(range(1, len(values) + 1))
        for j, r in by[name].items():
            assert r["n"] == n and r["deviation"] == sum(v * v for v in spread[k])
            assert abs(abs(r["whitened"]) - abs(expected[k, j - 1])) < 1e-6
            assert abs(r["explained"] / (values[j - 1] / np.trace(covariance)) - 1) < 1e-9
            assert r["identity_error"] < 1e-9


def test_whitened_equals_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(c) for c in rng.standard_normal(12) * np.arange(1, 13)]) for k in range(200)]
    bad = [(900, None), (901, [1.0, None]), (902, [float("nan")] * 12), (903, [float("inf")])]
    check(whitening.whitened(frame(spark, rows + bad), 8).collect(), rows, 8)


def test_short_vectors_and_few_directions(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(a), float(2 * a), 0.0]) for k, a in enumerate(rng.standard_normal(50))]
    rows += [(100, []), (101, [4.0]), (102, [4.0, 8.0, 0.0])]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2} and len(got) == 2 * len(rows)
    check(got, rows)


def test_odd_tables(spark):
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whitened(frame(spark, [(1, []), (2, [])])).collect() == []
    rows = [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (3, [0.0, 1e30]), (1 << 60, [5.0, -3.0])]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert sorted(str(r["vec_id"]) for r in got if r["component"] == 1) == sorted(str(i) for i, _ in rows)
    assert all(r["deviation"] is None for r in got)


@pytest.mark.skipif(not SMALL.exists(), reason="no given tables")
def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(queries.op13_whitening(spark, str(SMALL)).collect(), rows)
