"""Operator 11 against numpy, in exact integers where the result is exact, and on awkward rows."""

import math
import os
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from ledgerspark.llm import whitening

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
EXTRA = ["d", "x", "n", "i", "j", "v", "component", "high", "low"]
SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       *[T.StructField(c, T.StringType()) for c in EXTRA]])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, *["e"] * len(EXTRA)) for i, v in rows], SCHEMA).repartition(3)


def usable(v):
    return bool(v) and all(c is not None and math.isfinite(c) for c in v)


def compare(rows, got, most=16):
    """``got`` rows against a dense solution per vector length."""
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    for d in {len(v) for _, v in rows if usable(v)}:
        own = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if usable(v) and len(v) == d]
        fit = sorted({tuple(x) for _, x in own})
        n, sums = len(fit), [sum(col) for col in zip(*fit)]
        centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
        v = centred.T @ centred / n
        e, u = np.linalg.eigh(v)
        e, u = e[::-1], u[:, ::-1]
        k = sum(e[:most] > 1e-12 * max(e[0], 1e-300)) if np.trace(v) else 0
        for i, x in own:
            z = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
            for c in range(1, k + 1):
                for r in by[i, c]:
                    assert r.n == n and r.identity_error < 1e-4
                    assert math.isclose(r.explained, e[c - 1] / np.trace(v), rel_tol=1e-9)
                gap = min(abs(e[c - 1] - other) for j, other in enumerate(e) if j != c - 1) / e[0] if d > 1 else 1
                if gap > 1e-6:
                    value = z @ u[:, c - 1] / math.sqrt(e[c - 1])
                    assert any(math.isclose(abs(r.whitened), abs(value), rel_tol=1e-6, abs_tol=1e-6) for r in by[i, c])
                deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
                assert deviation in [r.deviation for r in by[i, c]]
            assert not (i, k + 1) in by or any(len(v2) != d for i2, v2 in rows if i2 == i and usable(v2))


def test_whiten(spark):
    rng = np.random.RandomState(4)
    mix = rng.randn(20, 20)
    rows = [(i, (rng.randn(20) @ mix).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # one very common vector
    rows += [(2000, None), (2001, []), (2002, [None] * 20), (2003, [float("nan")] + [0.0] * 19), (2004, [float("inf")] * 20), (None, rows[1][1])]
    rows += [(5, rows[5][1])] * 2
    compare(rows, whitening.whiten(frame(spark, rows)).collect())


def test_lengths_and_ranks(spark):
    rng = np.random.RandomState(5)
    rows = [(i, rng.randn(3).tolist()) for i in range(50)] + [(100 + i, rng.randn(40).tolist()) for i in range(6)]
    rows += [(200, [1.0] * 7), (201, [1.0] * 7), (300, [5.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    compare(rows, got)
    assert {r.vec_id for r in got} == set(range(50)) | set(range(100, 106))  # no variance, no component
    assert max(r.component for r in got if r.vec_id >= 100) == 5
    assert whitening.whiten(frame(spark, [])).count() == 0


def test_beyond_a_long(spark):
    rows = [(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [0.0, 2.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {(r.vec_id, r.deviation) for r in got} == {(0, None), (1, None), (2, None)} or all(r.deviation is None for r in got if r.vec_id < 2)


@pytest.mark.parametrize("matrix", [
    np.eye(30), np.diag([1.0] * 10 + [1 - 1e-9] * 10 + [0.5] * 10), np.kron(np.eye(8), np.array([[2.0, 1], [1, 2]])),
    np.array([[2.0]]), np.diag(np.arange(5.0)), np.ones((6, 6))])
def test_eigen_of_clusters(matrix):
    k = min(16, len(matrix))
    values, vectors = whitening.eigen(matrix, k)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:k], atol=1e-13)
    assert np.allclose(matrix @ vectors, vectors * values, atol=1e-13)
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-13)


def test_eigen_at_random():
    rng = np.random.RandomState(6)
    for n in (2, 3, 17, 64, 150):
        a = rng.randn(n, 2 * n) * 10.0 ** rng.uniform(-4, 0, (n, 1))
        a = a @ a.T
        k = min(16, n)
        values, vectors = whitening.eigen(a, k)
        scale = np.abs(a).max()
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], atol=1e-12 * scale * n, rtol=0)
        assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * scale * n
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


@needs_data
def test_query(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    rows = list(zip(table["vec_id"], table["embedding"]))
    got = whitening.query(spark, SF).collect()
    assert len(got) == 16 * len(rows)
    compare(rows, got)
