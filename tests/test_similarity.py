import math
import random

import numpy as np
import pytest

from caseloom.functions.vectors import cosine
from caseloom.operators.similarity import top_matches, top_similarity

SCHEMA = "ticket_id string, issue_category string, embedding array<double>"
ENRICH_SCHEMA = "ticket_id string, customer_summary string, next_best_action string"


def py_cosine(a, b):
    dot = sum(x * y for x, y in zip(a, b))
    na = math.sqrt(sum(x * x for x in a))
    nb = math.sqrt(sum(x * x for x in b))
    if na == 0 or nb == 0:
        return 0.0
    return dot / (na * nb)


def brute_force(records, top_n):
    """All ordered pairs, stable sort by score: the plain single-process method."""
    out = []
    for left in records:
        scored = [(py_cosine(left[2], r[2]), r) for r in records if r[0] != left[0]]
        scored.sort(key=lambda s: -round(s[0], 12))  # stable: input order on ties
        for rank, (score, r) in enumerate(scored[:top_n], start=1):
            out.append((left[0], r[0], rank, round(score, 6)))
    return sorted(out)


def _records():
    rng = random.Random(7)
    recs = []
    for i in range(1, 41):
        dim = 8 if i % 13 else 5  # a few shorter vectors
        recs.append((f"T{i:03d}", f"CAT{i % 3}", [rng.uniform(-1, 1) for _ in range(dim)]))
    recs.append(("T041", "CAT0", [0.0] * 8))                      # zero vector
    recs.append(("T042", "CAT1", [-x for x in recs[0][2]]))       # opposite of T001
    recs.append(("T043", "CAT2", list(recs[1][2])))               # exact tie with T002
    recs.append(("T044", "CAT2", list(recs[1][2])))
    recs.append(("T045", "CAT0", [rng.uniform(-1, 1) for _ in range(8)]))
    recs.append(("T045", "CAT0", [rng.uniform(-1, 1) for _ in range(8)]))  # duplicate id, other vector
    recs.append(("T046", "CAT1", list(recs[5][2])))
    recs.append(("T046", "CAT1", list(recs[5][2])))               # exact copy of a row
    return recs


@pytest.mark.parametrize("blocks,chunk", [(1, 1024), (3, 1024), (3, 4)])
def test_top_matches_equals_brute_force(spark, blocks, chunk):
    recs = _records()
    df = spark.createDataFrame(recs, SCHEMA)
    got = top_matches(df, None, top_n=3, num_blocks=blocks, chunk_rows=chunk).select(
        "ticket_id", "matched_ticket_id", "similarity_rank", "similarity_score").collect()
    got = sorted((r[0], r[1], r[2], r[3]) for r in got)
    want = brute_force(recs, 3)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:3] == w[:3], (g, w)
        assert abs(g[3] - w[3]) <= 1e-6


def test_small_inputs(spark):
    one = spark.createDataFrame([("T1", "A", [1.0, 0.0])], SCHEMA)
    assert top_matches(one, None, num_blocks=2).count() == 0
    two = spark.createDataFrame([("T1", "A", [1.0, 0.0]), ("T2", "B", [0.0, 1.0])], SCHEMA)
    rows = top_matches(two, None, top_n=3).collect()
    assert sorted((r.ticket_id, r.matched_ticket_id, r.similarity_rank, r.similarity_score) for r in rows) == [
        ("T1", "T2", 1, 0.0), ("T2", "T1", 1, 0.0)]


def test_summaries_attached(spark):
    df = spark.createDataFrame([("T1", "A", [1.0, 0.0]), ("T2", "B", [1.0, 0.1])], SCHEMA)
    enr = spark.createDataFrame([("T1", "s1", "a1"), ("T2", "s2", "a2")], ENRICH_SCHEMA)
    r = top_matches(df, enr).filter("ticket_id = 'T1'").collect()[0]
    assert (r.ticket_summary, r.matched_ticket_summary, r.recommended_action_pattern) == ("s1", "s2", "a2")
    assert (r.ticket_issue_category, r.matched_issue_category) == ("A", "B")


def test_cosine_column_form(spark):
    pairs = [([1.0, 2.0, 3.0], [3.0, 2.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0, 2.0], [1.0, 2.0, 5.0]),
             ([1.0, -1.0], [-1.0, 1.0])]
    df = spark.createDataFrame(pairs, "a array<double>, b array<double>")
    got = [r.c for r in df.select(cosine("a", "b").alias("c")).collect()]
    for (a, b), g in zip(pairs, got):
        assert abs(g - py_cosine(a, b)) < 1e-12


def test_top_similarity_picks_rank_one(spark):
    sim = spark.createDataFrame(
        [("T1", "T2", 2, 0.5), ("T1", "T3", 1, 0.9), ("T2", "T1", 1, 0.9), ("T2", "T1", 1, 0.9)],
        "ticket_id string, matched_ticket_id string, similarity_rank int, similarity_score double")
    out = {r.ticket_id: r for r in top_similarity(sim).collect()}
    assert out["T1"].matched_ticket_id == "T3" and out["T2"].similarity_rank == 1 and len(out) == 2


def test_blocked_plan_never_builds_pairs(spark):
    df = spark.createDataFrame(_records(), SCHEMA)
    plan = top_matches(df, None, num_blocks=3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "FlatMapGroupsInPandas" in plan


def test_many_copies_are_emitted_in_pieces(spark):
    rows = [("T1", "A", [1.0, 0.0])] * 7 + [("T2", "B", [1.0, 1.0]), ("T3", "C", [0.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = top_matches(df, None, top_n=2, num_blocks=2, copy_chunk=3).collect()
    want = top_matches(df, None, top_n=2, num_blocks=2).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert sum(1 for r in got if r.ticket_id == "T1") == 7 * 2


def test_column_form_equals_blocked_form(spark):
    """SURVEY 5.3 #4: the column-form cosine of each reported pair equals the
    blocked kernel's score."""
    import pyspark.sql.functions as F

    recs = [r for r in _records() if r[0] not in ("T045", "T046")]  # unique ids
    df = spark.createDataFrame(recs, SCHEMA)
    pairs = top_matches(df, None, top_n=3, num_blocks=3)
    a = df.select(F.col("ticket_id"), F.col("embedding").alias("ea"))
    b = df.select(F.col("ticket_id").alias("matched_ticket_id"), F.col("embedding").alias("eb"))
    joined = pairs.join(a, "ticket_id").join(b, "matched_ticket_id").select(
        "similarity_score", cosine("ea", "eb").alias("c"))
    rows = joined.collect()
    assert len(rows) == pairs.count() > 0
    assert all(abs(r.similarity_score - r.c) <= 5e-7 for r in rows)


def test_block_pair_keeps_only_the_best_of_every_tile(monkeypatch):
    """Of a pair of blocks no more than top_n candidates a row are ever held, whatever the number of tiles."""
    import tracemalloc

    import pandas as pd

    from caseloom.operators import similarity

    rng = np.random.default_rng(3)
    sides = []
    for name, n in (("A", 2000), ("B", 2100)):
        mat = np.round(rng.normal(size=(n, 4)), 1)  # few decimals: exact ties
        mat[5], mat[6] = 0.0, np.nan
        ids = [f"{name if i % 7 else 'S'}{i:05d}" for i in range(n)]  # some ids stand in both blocks
        frame = pd.DataFrame({"ticket_id": ids, "issue_category": "X", "_uid": np.arange(n), "_m": 1}).sort_values("ticket_id")
        sides.append((frame.reset_index(drop=True), similarity._unit_rows(mat[frame.index])))
    (left, ul), (right, ur) = sides
    monkeypatch.setattr(similarity, "SCORE_CELLS", 10_000)
    tracemalloc.start()
    got = pd.concat(similarity._block_pair(left, right, ul, ur, 3, 10, both=True))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000_000  # 200 tiles' candidates of the right rows would be over 50 MB
    whole = ul @ ur.T
    for mine, other, scores in ((left, right, whole), (right, left, whole.T)):
        key = np.where(np.isnan(scores), -np.inf, np.round(scores, similarity.RANK_DECIMALS))
        key[mine["ticket_id"].to_numpy()[:, None] == other["ticket_id"].to_numpy()[None, :]] = -np.inf
        best = np.argsort(-key, axis=1, kind="stable")[:, :3]
        found = got[got["ticket_id"].isin(mine["ticket_id"]) & got["matched_ticket_id"].isin(other["ticket_id"])]
        names = found.groupby("ticket_id")["matched_ticket_id"].agg(list)
        for i in range(0, len(mine), 11):
            name = mine["ticket_id"][i]
            if not name.startswith("S") and np.isfinite(key[i, best[i]]).all():
                assert names[name] == list(other["ticket_id"].to_numpy()[best[i]])
    assert len(got) == 3 * (len(left) + len(right))


def test_blocks_are_read_batch_by_batch():
    """A task holds every vector once, not the whole group's frames beside them; rows stand in the order ties are settled in."""
    import tracemalloc

    import pandas as pd

    from caseloom.operators import similarity

    rng, size, batches = np.random.default_rng(5), 2000, 20
    odd = {3: None, 4: np.array([]), 5: np.array([1.0, np.nan]), 6: np.zeros(64)}

    def frame(k):
        vectors = [odd.get(i, v) if k == 0 else v for i, v in enumerate(np.random.default_rng(k).normal(size=(size, 64)))]
        return pd.DataFrame({"_blk": rng.integers(0, 2, size) * 3 + 1, "_uid": np.arange(k * size, (k + 1) * size), "_m": 1,
                             "ticket_id": [None if i == 9 else f"T{i * 7 % 500}" for i in range(size)], "issue_category": "X", "embedding": vectors})

    tracemalloc.start()
    got = similarity._blocks_of(frame(k) for k in range(batches))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.5 * batches * size * 64 * 8  # with the frames it would be over 3
    assert [len(f.columns) for f, _ in got] == [4, 4] and sum(len(f) for f, _ in got) == batches * size
    for f, unit in got:
        key = list(zip(f["ticket_id"].fillna(""), f["_uid"]))
        assert key == sorted(key) and unit.shape == (len(f), 64)
        for uid, row in list(zip(f["_uid"], unit))[::97]:
            v = np.random.default_rng(uid // size).normal(size=(size, 64))[uid % size]
            assert uid in odd or np.allclose(row, v / np.linalg.norm(v), atol=1e-15)
        for uid, row in zip(f["_uid"], unit):
            if uid in odd:
                assert np.isnan(row).any() if uid == 5 else not row.any()


def test_scores_above_a_limit_in_either_direction():
    from caseloom.operators.similarity import _exceeding

    scores = np.random.default_rng(6).normal(size=(7, 11))
    scores[2, 3] = np.nan
    for m in (scores, np.asfortranarray(scores), scores.T):
        limit = np.linspace(-1, 1, len(m))
        at, col = _exceeding(m, limit)
        assert sorted(zip(at, col)) == sorted(zip(*np.nonzero(m > limit[:, None])))


def test_scores_that_all_count_are_looked_through_some_rows_at_a_time():
    """Where every score ties or beats its row's limit, a tile needs little beside itself, and the best are the first."""
    import tracemalloc

    from caseloom.operators.similarity import _Best

    ones = np.ones((1024, 1953))
    for scores in (ones, ones.T):
        (n, m), ids = scores.shape, np.arange(max(scores.shape))
        worse, best = scores - 2, _Best(n, 3)
        tracemalloc.start()
        best.offer(worse, ids[:n], ids[:m], 0, 0)  # ties: equal ids don't match
        ties = best.place.copy()
        best.offer(scores, ids[:n], -1 - ids[:m], 0, m)  # all above the limit
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 2.5 * ones.nbytes  # 12 times that when the whole tile was looked through at once
        for i in (0, 1, 2, 3, 900, n - 1):
            assert list(ties[i]) == [p for p in range(4) if p != i][:3]
        assert (best.place == m + np.arange(3)).all() and (best.key == 1).all()


def test_blocks_are_sized_by_the_rows_that_are_compared(spark, workdir, monkeypatch):
    """A vector meets every ticket of its id: tickets that share one make more rows than there are vectors, and copies make none."""
    from datetime import datetime

    from caseloom.operators import similarity
    from caseloom.plans import queries

    rng = np.random.default_rng(8)
    vectors = [(i, [float(x) for x in rng.normal(size=8)], 0) for i in range(12)]
    events = [(i, datetime(2024, 1, 1), i, "click", 20.0, '{"k": %d}' % k) for i in range(12) for k in (0, 1, 2, 3, 4, 4, 4)]
    for name, rows, schema in (
            ("embeddings", vectors, "vec_id long, embedding array<float>, label int"),
            ("events", events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
            ("orders", [(i, i) for i in range(12)], "o_orderkey long, o_custkey long")):
        spark.createDataFrame(rows, schema).write.parquet(f"{workdir}/{name}.parquet")
    sized, choose = [], similarity.choose_blocks

    def seen(n_rows, block_rows, parallelism):
        sized.append(n_rows)
        return choose(n_rows, block_rows, parallelism)

    monkeypatch.setattr(similarity, "choose_blocks", seen)
    got = queries.ticket_similarity(spark, workdir)
    assert sized == [60]  # 12 vectors x 5 categories
    enrichment = queries.ticket_enrichment(spark, workdir)
    want = similarity.top_matches(queries.ticket_embeddings(spark, workdir, enrichment), enrichment, top_n=3, num_blocks=1)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 12 * 7 * 3
