"""Whitening against a dense eigensolver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmill.llm import op11_whitening as white


def dense(vectors):
    """Integer vectors, their distinct ones, and the eigenpairs of the covariance by falling eigenvalue."""
    x = np.floor(np.array(vectors, np.float64) * 64).astype(np.int64) + 1_000_000
    unique = np.unique(x, axis=0)
    c = unique - unique.sum(0) / len(unique)
    values, turn = np.linalg.eigh(c.T @ c / len(unique))
    return x, unique, values[::-1], turn[:, ::-1]


def check(rows, ids, vectors, k):
    x, unique, values, turn = dense(vectors)
    n, sums = len(unique), unique.sum(0)
    want = {i: (v - sums / n) @ (turn[:, :k] / np.sqrt(values[:k])) for i, v in zip(ids, x)}
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert got.keys() == want.keys() and all(sorted(g) == list(range(1, k + 1)) for g in got.values())
    sign = np.sign(sum(np.array([got[i][j + 1].whitened for j in range(k)]) * want[i] for i in ids))
    for i, v in zip(ids, x):
        one = [got[i][j + 1] for j in range(k)]
        assert np.allclose([r.whitened for r in one], want[i] * sign, atol=1e-8)
        assert {(r.n, r.deviation) for r in one} == {(n, int(((n * v - sums) ** 2).sum()))}
        assert np.allclose([r.explained for r in one], values[:k] / values.sum(), rtol=1e-9)
        assert all(0 <= r.identity_error < 1e-9 for r in one)


def test_query_equals_a_dense_eigensolver(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").toPandas()
    rows = white.op11_whitening(spark, "/root/testdata/sf0.001").collect()
    check(rows, table.vec_id.tolist(), table.embedding.tolist(), 16)


@pytest.mark.parametrize("spectrum", ["flat", "clustered", "falling", "deficient"])
def test_hard_spectra(spectrum):
    rng = np.random.default_rng(2)
    d, k = 120, 16
    values = {"flat": np.linspace(70, 60, d), "clustered": np.concatenate([np.full(17, 9.0), np.full(d - 17, 8.9)]),
              "falling": 2.0 ** -np.arange(d), "deficient": np.concatenate([np.linspace(5, 1, 10), np.zeros(d - 10)])}[spectrum]
    turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
    v = turn * values @ turn.T
    passes = []
    found, vectors, residual = white.leading_pairs(lambda b: (passes.append(1), v @ b)[1], d, k)
    assert np.allclose(found, np.sort(values)[::-1][:k], atol=1e-11 * values.max()) and len(passes) < 200
    assert np.abs(v @ vectors - vectors * found).max() <= white.ROUNDED * values.max()
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
    low = white.lower_bound(lambda b: v @ b, d)
    assert 0 <= low <= values.min() + 1e-9 * values.max()


def test_filter_is_the_chebyshev_polynomial():
    """Against the closed form: cos(n arccos t) inside, cosh outside, scaled to 1 at the top."""
    values = np.array([1.0, 2.0, 3.5, 4.0, 6.0, 10.0])
    v, block = np.diag(values), np.eye(6)
    low, cut, top, degree = 1.0, 4.0, 10.0, 7
    out = np.diag(white.chebyshev(lambda b: v @ b, block, v @ block, low, cut, top, degree))

    def t(x):
        s = (x - (cut + low) / 2) / ((cut - low) / 2)
        return np.cos(degree * np.arccos(s)) if abs(s) <= 1 else np.cosh(degree * np.arccosh(s))

    assert np.allclose(out, [t(x) / t(top) for x in values], atol=1e-12)


def test_edges(spark):
    """Missing vectors and entries, NaN and infinities, odd lengths, repeated ids and vectors, clashing columns."""
    rng = np.random.default_rng(4)
    plain = [[float(c) for c in rng.normal(size=5)] for _ in range(40)]
    rows = [(i, v) for i, v in enumerate(plain)] + [(100 + i, plain[0]) for i in range(30)]
    bad = [(200, None), (201, [None] * 5), (202, [1.0, 2.0, float("nan"), 0.0, 0.0]), (203, [float("inf")] * 5), (204, [1.0]), (205, [])]
    df = spark.createDataFrame([(i, v, "x", 1, 2.0) for i, v in rows + bad], "vec_id long, embedding array<double>, x string, component int, deviation double")
    check(white.whitened_rows(df, 3).collect(), [i for i, _ in rows], [v for _, v in rows], 3)
    usable = white.integer_vectors(df)
    model, unique = white.fit(usable, 3)
    assert unique.count() == 40
    out = white.transform(usable, model)
    assert out.columns == ["vec_id", "embedding", "component", "deviation", "whitened"] and out.count() == len(rows)
    twice = white.whitened_rows(df.where("vec_id < 40").unionAll(df.where("vec_id = 7")).withColumn("vec_id", F.nullif("vec_id", F.lit(3))), 3).collect()
    assert len(twice) == 41 * 3 and sum(r.vec_id == 7 for r in twice) == 6 and sum(r.vec_id is None for r in twice) == 3


def test_nothing_to_scale(spark):
    schema = "vec_id long, embedding array<float>"
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = white.whitened_rows(spark.createDataFrame(rows, schema))
        assert out.columns == names and out.collect() == []
    one = white.whitened_rows(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0])], schema)).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9), round(r.explained, 9)) for r in one) == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]
    with pytest.raises(ArithmeticError):
        white.whitened_rows(spark.createDataFrame([(1, [1e8]), (2, [-1e8])], schema))
