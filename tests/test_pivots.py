"""Pivot pruning gives the same rows as comparing all blocks, and skips blocks where vectors lie in clusters."""

import numpy as np
import pytest

from caseloom.operators import pivots
from caseloom.operators.similarity import top_matches

SCHEMA = "ticket_id string, issue_category string, embedding array<double>"


def clustered(n, clusters, dim, spread, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return [(f"T{i:05d}", f"c{i % 3}", (centres[i % clusters] + spread * rng.normal(size=dim)).tolist()) for i in range(n)]


def odd(dim):
    rng = np.random.default_rng(9)
    some = rng.normal(size=dim).tolist()
    grid = [[float(x), float(y)] + [0.0] * (dim - 2) for x in (-1, 0, 1) for y in (-1, 0, 1)]  # many equal scores, a zero vector
    rows = [(f"G{i % 7}", "g", v) for i, v in enumerate(grid * 3)]  # ids with several vectors, exact copies
    rows += [(f"N{i}", None, v) for i, v in enumerate([None, [], [0.0] * dim, some[:3], some, [-x for x in some], [2 * x for x in some]])]
    return rows + [(None, "n", some), ("Z", "z", [0.0] * dim), ("Q", "q", [float("nan")] + [1.0] * (dim - 1))] + [("copy", "c", some)] * 5


def both(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    stats = {}
    pruned = top_matches(df, top_n=3, pivots=4, stats=stats, **options)
    plain = top_matches(df, top_n=3, num_blocks=2)
    return sorted(map(repr, pruned.collect())), sorted(map(repr, plain.collect())), stats


@pytest.mark.parametrize("rows,block_rows", [
    (clustered(400, 8, 12, 0.05, 1), 40), (clustered(300, 300, 6, 1.0, 2), 25), (odd(6), 7), (clustered(120, 5, 6, 0.1, 3) + odd(6), 16),
    (odd(6)[:1], 5), ([], 5), ([("A", "a", None), ("B", "b", [])], 5)])
def test_same_rows_as_all_pairs(spark, rows, block_rows):
    pruned, plain, _ = both(spark, rows, block_rows=block_rows)
    assert pruned == plain


def test_blocks_are_skipped(spark):
    pruned, plain, stats = both(spark, clustered(600, 12, 24, 0.02, 4), block_rows=50)
    assert pruned == plain and stats["blocks"] >= 12
    assert stats["visits"] + stats["skipped"] == stats["rows"] * (stats["blocks"] - 1) and stats["skipped"] > 0.7 * stats["rows"] * (stats["blocks"] - 1)


def test_bounds_hold_for_every_pair():
    rng = np.random.default_rng(5)
    unit = rng.normal(size=(200, 5))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    angles = pivots._angles(unit, unit[:3])
    blocks = np.arange(200) % 10
    table = pivots.MetricTable(np.array([angles[blocks == b].min(axis=0) for b in range(10)]), np.array([angles[blocks == b].max(axis=0) for b in range(10)]))
    bounds = table.bounds(angles)
    for b in range(10):
        assert ((unit @ unit[blocks == b].T).max(axis=1) <= bounds[:, b]).all()
