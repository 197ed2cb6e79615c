"""Whitening against numpy's eigenvectors of the exact covariance."""

import math

import numpy as np
import pytest

from tempora.llm import queries, whitening


def brute(x):
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums) / n
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    return values[::-1], axes[:, ::-1], centred, ((n * x - sums) ** 2).sum(1), np.trace(cov)


def matrix(rows, k):
    rows = sorted(rows, key=lambda r: (r.vec_id, r.component))
    return np.array([r.whitened for r in rows]).reshape(-1, k), rows


def test_query_equals_numpy(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    kept = sorted((r.vec_id, r.embedding) for r in rows if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding))
    x = np.floor(np.array([v for _, v in kept], float) * 64).astype(np.int64) + 1_000_000
    values, axes, centred, deviation, trace = brute(x)
    got, rows = matrix(queries.op13_svd_whitening(spark, "/root/testdata/sf0.001").collect(), 32)
    want = centred @ axes[:, :32] / np.sqrt(values[:32])
    assert got.shape == want.shape
    sign = np.sign((got * want).sum(0))
    assert np.abs(got * sign - want).max() < 1e-8
    assert [r.deviation for r in rows[::32]] == deviation.tolist()
    assert np.allclose([r.explained for r in rows[:32]], values[:32] / trace, rtol=1e-10)
    assert {r.n for r in rows} == {len(x)} and max(r.identity_error for r in rows) < 1e-9


def test_rows_that_are_no_vectors_are_dropped(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 2.0]), (2, None), (3, [nan, 0.0]), (4, [inf, 0.0]), (5, [None, 1.0]), (6, [-1.0, 0.5]), (6, [-1.0, 0.5]), (7, [0.25, -3.0]), (None, [0.5, 0.5])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in data], "vec_id long, embedding array<float>, id int, x int")
    rows = whitening.whiten(df).collect()
    assert sorted(((r.vec_id, r.component) for r in rows), key=str) == sorted([(i, c) for i in (1, 6, 6, 7, None) for c in (1, 2)], key=str)
    assert {r.n for r in rows} == {5}
    x = np.array([[1, 2], [-1, 0.5], [-1, 0.5], [0.25, -3], [0.5, 0.5]]) * 64 + 1_000_000
    values, axes, centred, deviation, trace = brute(x.astype(np.int64))
    assert {r.vec_id: r.deviation for r in rows} == {1: deviation[0], 6: deviation[1], 7: deviation[3], None: deviation[4]}
    one = {r.vec_id: abs(r.whitened) for r in rows if r.component == 1}
    assert np.isclose(one[7], abs(centred[3] @ axes[:, 0] / np.sqrt(values[0])))


def test_components_without_variance_do_not_exist(spark):
    flat = spark.createDataFrame([(k, [float(k), 2.0 * k, 1.0]) for k in range(20)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(flat).collect()
    assert {r.component for r in rows} == {1} and abs(rows[0].explained - 1) < 1e-12 and rows[0].identity_error < 1e-9
    for data in ([(1, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)], [], [(k, [3.0, 3.0]) for k in range(5)]):
        df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
        assert whitening.whiten(df).count() == 0


def test_vectors_that_cannot_be_are_errors(spark):
    with pytest.raises(ValueError, match="2 and of 3"):
        whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])], "vec_id long, embedding array<float>"))
    with pytest.raises(Exception, match="2\\^53"):
        whitening.whiten(spark.createDataFrame([(1, [1e30, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>"))


def test_fewer_components_and_equal_eigenvalues(spark):
    corners = [(k, [float(a), float(b), float(c)]) for k, (a, b, c) in enumerate(np.ndindex(2, 2, 2))]
    rows = whitening.whiten(spark.createDataFrame(corners, "vec_id long, embedding array<double>"), components=2).collect()
    got, _ = matrix(rows, 2)
    assert np.abs(got.T @ got / 8 - np.eye(2)).max() < 1e-9
