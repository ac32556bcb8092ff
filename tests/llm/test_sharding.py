"""The hypergeometric matrix against exact laws, and shards against their definition."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import sharding

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def chi_square(seen: Counter, law: dict, n: int) -> float:
    assert set(seen) <= set(law)
    return sum((seen[k] - n * p) ** 2 / (n * p) for k, p in law.items())


@pytest.mark.parametrize("good,bad,drawn", [(3, 5, 4), (10, 2, 7), (1, 40, 20), (6, 6, 6), (0, 5, 3), (5, 0, 3)])
def test_draws_follow_the_law(good, bad, drawn):
    rng, n = np.random.default_rng(1), 6000
    seen = Counter(sharding.hypergeometric(rng, good, bad, drawn) for _ in range(n))
    law = {k: math.comb(good, k) * math.comb(bad, drawn - k) / math.comb(good + bad, drawn)
           for k in range(max(0, drawn - bad), min(good, drawn) + 1)}
    assert chi_square(seen, law, n) < 3 * len(law) + 20


def test_huge_draws():
    rng = np.random.default_rng(2)
    draws = [sharding.hypergeometric(rng, 10 ** 10, 23 * 10 ** 10, 10 ** 9) for _ in range(200)]
    mean, sd = 10 ** 9 / 24, math.sqrt(10 ** 9 / 24 * 23 / 24)
    assert abs(np.mean(draws) - mean) < 4 * sd / math.sqrt(200) and 0.8 < np.std(draws) / sd < 1.2


def test_matrix_rows_sum_up():
    counts = [5, 0, 17, 1, 9, 30, 2]
    starts = np.concatenate(([0], np.cumsum(counts))).tolist()
    sizes = sharding.shard_sizes(sum(counts), 6)
    rows = [sharding.matrix_row(p, starts, sizes, 7) for p in range(len(counts))]
    assert [int(r.sum()) for r in rows] == counts
    assert np.array_equal(np.sum(rows, axis=0), sizes) and sizes.max() - sizes.min() <= 1


def test_matrix_is_uniform():
    """Two rows of one partition and two of another over shards of two: each of the 6 ways to share is as likely."""
    seen, n = Counter(), 4000
    for seed in range(n):
        seen[tuple(sharding.matrix_row(0, [0, 2, 4], sharding.shard_sizes(4, 2), seed).tolist())] += 1
    assert chi_square(seen, {(2, 0): 1 / 6, (1, 1): 4 / 6, (0, 2): 1 / 6}, n) < 15


def check(rows, shards=sharding.SHARDS):
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(shards))
    assert max(sizes.values()) - (min(sizes.values()) if len(sizes) == shards else 0) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = sharding.op12_sharding(spark, sf).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check(rows)
    import zlib
    assert {r.doc_id: (r["size"], r.text_crc32, r.law, r.grown_shard) for r in rows} == {
        i: (len(t.encode()) + 8, zlib.crc32(t.encode()), "rows", None) for i, t in docs.items()}
    again = sharding.op12_sharding(spark, sf).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in rows}


def test_pairs_meet_as_often_as_by_chance(spark):
    docs = spark.range(0, 240, 1, 5).withColumnRenamed("id", "doc_id")
    together = neighbours = 0
    for seed in range(12):
        rows = sharding.shard(docs, 4, seed).collect()
        check(rows, 4)
        of = {r.doc_id: (r.shard, r.slot) for r in rows}
        together += sum(of[i][0] == of[i + 1][0] for i in range(239))
        neighbours += sum(of[i][0] == of[i + 1][0] and of[i][1] < of[i + 1][1] for i in range(239))
    chance = 12 * 239 * 59 / 239
    assert abs(together - chance) < 5 * math.sqrt(chance) and abs(neighbours - chance / 2) < 5 * math.sqrt(chance / 2)


def test_odd_rows(spark):
    rows = [(1, None, "en", "s", 1), (None, "", None, None, None), (2, "x" * 200000, "en", "s", 2)] + [(3, "copy", "de", "t", 3)] * 50
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("shard", "slot", "part", "count", "key", "in", "size"):
        df = df.withColumn(c, F.lit("clash"))
    got = sharding.shard(df)
    assert set(got.columns) == set(df.columns) and sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(str(r[0]) for r in rows)
    check(got.collect())
    assert sharding.shard(df.limit(0)).collect() == []
    check(sharding.shard(df.limit(3), 24).collect())


def test_shards_on_disk(spark, workdir):
    docs = spark.range(100).withColumnRenamed("id", "doc_id")
    sharding.write_shards(docs, f"{workdir}/shards", 4)
    back = spark.read.parquet(f"{workdir}/shards")
    assert {(r.doc_id, r.shard, r.slot) for r in back.collect()} == {(r.doc_id, r.shard, r.slot) for r in sharding.shard(docs, 4).collect()}
