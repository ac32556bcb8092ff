"""Ties between different vectors, doubles, and vectors of any magnitude against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import ann


def found(spark, rows, asks, kind="double", k=20, **options):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")
    out = {}
    for r in ann.nearest(df, k, F.col("vec_id").isin(asks), **options).collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    return {q: [v[i] for i in sorted(v)] for q, v in out.items()}


def brute(rows, query, k=20):
    own = dict(rows)[query]
    scored = [(-float(np.dot(np.array(v, float), np.array(own, float))), i) for i, v in rows if i != query]
    return [(i, pytest.approx(-s, rel=1e-12)) for s, i in sorted(scored)[:k]]


def test_all_scores_equal(spark):
    rows = [(1000, [1.0, 0.0, 0.0])] + [(i, [0.5, float(i), 0.0]) for i in range(1, 200)]
    got = found(spark, rows, [1000])
    assert [i for i, _ in got[1000]] == list(range(1, 21)) and {s for _, s in got[1000]} == {0.5}


def test_ties_over_several_shards(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(0, 2, 12)]) for i in rng.permutation(700).tolist()]
    rows = [(i, v) for i, v in rows if any(v)]
    asks = [i for i, _ in rows if i % 50 == 0]
    got = found(spark, rows, asks, "float", shard_rows=200)
    for q in asks:
        assert [s for _, s in got[q]] == [s for _, s in brute(rows, q)]
        assert [i for i, _ in got[q]] == [i for i, _ in brute(rows, q)]


def test_doubles_are_scored_as_doubles(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    rows = [(i, (base + 1e-12 * rng.normal(size=8)).tolist()) for i in range(30)]  # alike in single precision
    got = found(spark, rows, [0, 7])
    for q in (0, 7):
        assert [i for i, _ in got[q]] == [i for i, _ in brute(rows, q)]


def test_any_magnitude(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * 10.0 ** rng.choice([-120, 0, 120])).tolist()) for i in range(60)]
    got = found(spark, rows, [0, 20])
    assert all(len(v) == 20 for v in got.values())
    for q, hits in got.items():
        assert [i for i, _ in hits[:3]] == [i for i, _ in brute(rows, q)[:3]]
