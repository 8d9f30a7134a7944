"""Mined negatives against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmill.llm import op13_hard_negatives as mine


def brute(rows, anchors, scale, asked):
    """rows: (vec_id, label, vector); all pairs in plain integers."""
    x = [[math.floor(c * scale) for c in v] for _, _, v in rows]
    last = 2**63

    def first(found, n):
        return sorted(found, key=lambda f: (-f[0], last if rows[f[1]][0] is None else rows[f[1]][0]))[:n]

    out = []
    for a in anchors:
        score = [(sum(p * q for p, q in zip(x[a], v)), i) for i, v in enumerate(x) if i != a]
        for p, i in first([s for s in score if rows[s[1]][1] == rows[a][1]], asked.positives):
            fit = [s for s in score if rows[s[1]][1] != rows[a][1] and asked.low * p <= 100 * s[0] <= asked.high * p]
            out += [(rows[a][0], rows[i][0], k + 1, rows[j][0], p, n) for k, (n, j) in enumerate(first(fit, asked.negatives))]
    return sorted(out, key=repr)


def vectors(seed, n, d, spread, clusters):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, d))
    v = centres[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, d))
    return (v * np.exp(rng.normal(0, 0.7, (n, 1)))).tolist()


@pytest.mark.parametrize("seed,d,spread,clusters", [(1, 8, 0.1, 6), (2, 3, 0.5, 2), (3, 24, 1.0, 4)])
def test_answers_equal_brute_force(spark, monkeypatch, seed, d, spread, clusters):
    """Lengths and clusters that prune, small buckets and blocks, one label with half of the rows."""
    monkeypatch.setattr(mine, "LEAST_ROWS", 40)
    rng = random.Random(seed)
    rows = [(i, 0 if rng.random() < 0.5 else rng.randrange(1, 4), v) for i, v in enumerate(vectors(seed, 400, d, spread, clusters))]
    df = spark.createDataFrame([(i, k, v, 5) for i, k, v in rows], "vec_id long, label int, embedding array<double>, block int")
    for asked in (mine.Mining(), mine.Mining(2, 4, 70, 100)):
        got = mine.hard_negatives(df, F.col("vec_id") % 20 == 0, 32, asked).collect()
        assert sorted(map(tuple, got), key=repr) == brute(rows, range(0, 400, 20), 32, asked)


def test_pruned_buckets_lose_no_score():
    """Every score of at least the needed one is reported, and pruning does take place."""
    rng = np.random.default_rng(6)
    x = (np.array(vectors(6, 6000, 12, 0.2, 10)) * 64).astype(np.int64)
    block = mine.Block(np.arange(6000), np.arange(6000), np.zeros(6000, np.int64), x, True)
    q = x[rng.integers(0, 6000, 40)]
    every = q @ x.T
    for share in (0.5, 0.9, 0.99):
        least = np.array([np.quantile(s, share) for s in every]).astype(np.float64)
        seen, looked = [set() for _ in q], 0
        for i, at, rows, score in block.scores(q, least):
            looked += len(rows)
            ids = block.ids[at + rows]
            assert (score == every[i, ids]).all()
            seen[i] |= set(ids[score >= least[i]].tolist())
        assert seen == [set(np.flatnonzero(s >= e).tolist()) for s, e in zip(every, least)]
    assert looked < 0.5 * every.size


def test_large_components_stay_exact(spark):
    big = 2.0**30
    rows = [(0, 1, [big, 1.0]), (1, 1, [big, 3.0]), (2, 2, [big / 2, 1.0]), (3, 2, [big / 2, 2.0]), (4, 2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = mine.hard_negatives(df, F.col("vec_id") == 0, 1, mine.Mining(5, 3, 10, 95)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, [0], 1, mine.Mining(5, 3, 10, 95)) and len(got) == 2
    with pytest.raises(ArithmeticError):
        mine.hard_negatives(df.withColumn("embedding", F.transform("embedding", lambda c: c * 16)), F.col("vec_id") == 0, 1)


def test_edges(spark):
    """Missing labels, vectors, entries and ids, repeated ids and vectors, ties, zero and opposite vectors, no rows."""
    rng = random.Random(9)
    good = [(50 * i, i % 3, [float(rng.randint(-3, 3)) for _ in range(4)]) for i in range(8)]
    good += [(7, 1, [1.0, 2.0, 0.0, 1.0])] * 3 + [(None, 2, [1.0, 2.0, 0.0, 1.0]), (8, 0, [0.0] * 4), (9, 0, [-1.0, -2.0, 0.0, -1.0])]
    good += [(100 + i, 2, [1.0, 2.0, 0.0, 1.0]) for i in range(1, 6)]
    bad = [(300, None, [1.0] * 4), (350, 1, None), (400, 1, [1.0, None, 1.0, 1.0]), (450, 1, [1.0, float("nan"), 1.0, 1.0]), (500, 1, [1.0])]
    schema = "vec_id long, label int, embedding array<float>"
    asked = mine.Mining(low=-100, high=100)
    for wanted in (mine.Mining(), asked):
        got = mine.hard_negatives(spark.createDataFrame(good + bad, schema), F.col("vec_id") % 50 == 0, 4, wanted).collect()
        anchors = [i for i, r in enumerate(good) if r[0] is not None and r[0] % 50 == 0]
        assert sorted(map(tuple, got), key=repr) == brute(good, anchors, 4, wanted)
    for rows in ([], bad[:2], [(0, 1, [1.0]), (1, 2, [1.0])], [(1, 1, [1.0]), (2, 1, [1.0])]):
        out = mine.hard_negatives(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0)
        assert out.collect() == [] and out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
