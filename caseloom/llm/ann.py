"""Approximate nearest neighbours by inner product over a robust-pruned directed graph, in shards.

Equal vectors are one class and are indexed once; for a search of k neighbours each class keeps its k + 1 smallest ids, more than
any answer can use. Classes are dealt to shards of bounded size. In a shard, inner product becomes Euclidean distance
by one more coordinate (the shard's largest norm makes all vectors equally long). The graph grows by batches: a greedy
beam search from the medoid proposes neighbours, relaxed pruning keeps a candidate only if no kept one is nearer to it by
the factor ``alpha``, edges are made mutual and pruned again, in two passes. Queries walk every shard's graph by
beam search; the best classes of all shards are merged and expanded to rows, scored in double precision on the vectors
as they are given. Where more classes tie at a shard's cut than it keeps, the walk goes on through all that tie, and the
classes of the smallest ids stay.

Results for odd input: vectors that are null, zero, empty, or hold a null or a non-finite number take no part; vectors of
any length and magnitude are searched at a common scale; ties go to the smaller id; repeated ids are rows of their own; null ids take no part; vectors of other lengths than the most frequent one
raise an error; with fewer candidates than k all are given; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from caseloom.llm.frames import cut, table

SHARD_ROWS = 8192
DEGREE = 32
BEAM = 64
QUERY_BEAM = 160
ALPHA = 1.2
BATCH = 256
QUERY_BLOCK = 4096


def beam_search(vectors: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int):
    """Greedy beam search for many queries at once: (ids, squared distances), nearest first; -1 and inf where none.

    ``edges`` holds the out-neighbours of each row, -1 where there are fewer.
    """
    n, q = len(vectors), len(queries)
    rows = np.arange(q)
    norms = (vectors * vectors).sum(1)
    own = (queries * queries).sum(1)
    ids = np.full((q, beam), -1)
    dist = np.full((q, beam), np.inf, np.float32)
    done = np.ones((q, beam), bool)
    ids[:, 0], done[:, 0] = entry, False
    dist[:, 0] = norms[entry] + own - 2 * queries @ vectors[entry]
    seen = np.zeros((q, n), bool)
    seen[:, entry] = True
    while True:
        open_ = np.where(done, np.inf, dist)
        best = open_.argmin(1)
        live = np.flatnonzero(np.isfinite(open_[rows, best]))
        if not len(live):
            return ids, dist
        at = best[live]
        done[live, at] = True
        near = edges[ids[live, at]]
        fresh = (near >= 0) & ~seen[live[:, None], near]
        seen[live[:, None], np.where(near >= 0, near, entry)] = True
        d = norms[near] + own[live, None] - 2 * np.einsum("ijk,ik->ij", vectors[near], queries[live])
        d = np.where(fresh, d, np.inf).astype(np.float32)
        all_d = np.concatenate([dist[live], d], 1)
        all_i = np.concatenate([ids[live], near], 1)
        all_done = np.concatenate([done[live], ~fresh], 1)
        keep = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        keep = np.take_along_axis(keep, np.argsort(np.take_along_axis(all_d, keep, 1), 1, kind="stable"), 1)
        dist[live] = np.take_along_axis(all_d, keep, 1)
        ids[live] = np.where(np.isfinite(dist[live]), np.take_along_axis(all_i, keep, 1), -1)
        done[live] = np.take_along_axis(all_done, keep, 1) | ~np.isfinite(dist[live])


def robust_prune(vectors: np.ndarray, points: np.ndarray, ids: np.ndarray, dist: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """The kept neighbours of each point among its candidates (-1 where fewer than ``degree``).

    Nearest first; a kept neighbour strikes out what lies nearer to it, by the factor alpha, than to the point.
    """
    order = np.argsort(dist, 1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    alive = np.isfinite(dist) & (ids >= 0) & (ids != points[:, None])
    cand = vectors[ids]
    norms = (cand * cand).sum(2)
    out = np.full((len(points), degree), -1)
    rows = np.arange(len(points))
    for k in range(degree):
        has = alive.any(1)
        if not has.any():
            break
        first = alive.argmax(1)
        out[has, k] = ids[rows, first][has]
        centre = cand[rows, first]
        gap = norms + norms[rows, first][:, None] - 2 * np.einsum("ijk,ik->ij", cand, centre)
        alive &= (alpha * alpha * gap > dist) & (ids != ids[rows, first][:, None]) & has[:, None]
    return out


def _once(rows: np.ndarray) -> np.ndarray:
    """Each row's ids without repeats, -1 in their place."""
    rows = np.sort(rows, 1)
    rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = -1
    return rows


def build_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 5):
    """(edges, entry) of the pruned graph over the vectors."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    entry = int(((vectors - vectors.mean(0)) ** 2).sum(1).argmin())
    edges = np.full((n, degree), -1)
    if n > 1:  # a random start
        edges[:, :min(8, n - 1)] = _once((np.arange(n)[:, None] + rng.integers(1, n, (n, min(8, n - 1)))) % n)
    for a in (1.0, alpha):
        order = rng.permutation(n)
        for lo in range(0, n, BATCH):
            points = order[lo:lo + BATCH]
            ids, dist = beam_search(vectors, edges, entry, vectors[points], beam)
            old = edges[points]
            gap = np.where(old >= 0, ((vectors[old] - vectors[points][:, None]) ** 2).sum(2), np.inf)
            edges[points] = robust_prune(vectors, points, np.concatenate([ids, old], 1), np.concatenate([dist, gap], 1), degree, a)
            # mutual edges: every chosen neighbour gets the point as a candidate
            src = np.repeat(points, degree)
            dst = edges[points].ravel()
            src, dst = src[dst >= 0], dst[dst >= 0]
            by = np.argsort(dst, kind="stable")
            targets, start, count = np.unique(dst[by], return_index=True, return_counts=True)
            width = int(count.max()) if len(count) else 0
            back = np.full((len(targets), width), -1)
            col = np.arange(len(dst)) - np.repeat(start, count)
            back[np.repeat(np.arange(len(targets)), count), col] = src[by]
            both = _once(np.concatenate([edges[targets], back], 1))
            room = (both >= 0).sum(1) <= degree
            packed = np.take_along_axis(both, np.argsort(both < 0, 1, kind="stable"), 1)
            edges[targets[room]] = packed[room][:, :degree]
            full, cand = targets[~room], packed[~room]
            if len(full):
                gap = np.where(cand >= 0, ((vectors[cand] - vectors[full][:, None]) ** 2).sum(2), np.inf)
                edges[full] = robust_prune(vectors, full, cand, gap, degree, a)
    return edges, entry


def with_ties(edges: np.ndarray, found: np.ndarray, floor: float, score) -> np.ndarray:
    """``found`` and all nodes that a walk over nodes of at least the score ``floor`` reaches from it."""
    seen = np.zeros(len(edges), bool)
    seen[found] = True
    walk, kept = found, [found]
    while len(walk):
        near = edges[walk].ravel()
        near = np.unique(near[near >= 0])
        near = near[~seen[near]]
        seen[near] = True
        walk = near[score(near) >= floor]
        kept.append(walk)
    return np.concatenate(kept)


def usable(vector) -> F.Column:
    """Not null, not empty, not all zero, every component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def classes_of(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(one row per distinct vector, its k + 1 smallest ids). Ids are cut down per salt before they meet."""
    key = F.struct(F.xxhash64("vector").alias("x"), F.xxhash64(F.lit(1), "vector").alias("y"))
    keyed = rows.withColumn("class", F.concat_ws("_", F.hex(key["x"]), F.hex(key["y"])))
    firsts = keyed.groupBy("class").agg(F.min("id").alias("id"), F.max_by("vector", "id").alias("vector"))
    salted = keyed.select("class", "id", (F.col("id") % 64).alias("salt"))
    within = Window.partitionBy("class", "salt").orderBy("id")
    some = salted.withColumn("r", F.row_number().over(within)).where(F.col("r") <= k + 1)
    members = some.withColumn("r", F.row_number().over(Window.partitionBy("class").orderBy("id"))).where(
        F.col("r") <= k + 1).select("class", "id")
    return firsts, members


def build_index(firsts: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row per shard: its classes, vectors, edges and entry, as arrays and bytes. At most about ``shard_rows`` each."""
    n = firsts.count()
    shards = max(1, -(-n // shard_rows))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("class")
        given = np.array(part["vector"].tolist(), np.float64)
        own = (given / np.abs(given).max()).astype(np.float32)  # a scale for the shard, so that no distance overflows
        norms = (own.astype(float) ** 2).sum(1)
        lifted = np.concatenate([own, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None].astype(np.float32)], 1)
        edges, entry = build_graph(lifted)
        single = bool((given == given.astype(np.float32)).all())  # then half the bytes hold the vectors as they are
        return pd.DataFrame({"shard": [int(part["shard"].iloc[0])], "classes": [part["class"].tolist()], "firsts": [part["id"].tolist()],
                             "entry": [entry], "dims": [own.shape[1]], "vectors": [lifted.tobytes()], "single": [single],
                             "given": [given.astype(np.float32 if single else np.float64).tobytes()], "edges": [edges.astype("<i4").tobytes()]})

    dealt = firsts.withColumn("shard", F.pmod(F.xxhash64("class", F.lit("shard")), F.lit(shards)).cast("int"))
    return dealt.select("shard", "class", "id", "vector").groupBy("shard").applyInPandas(
        build, "shard int, classes array<string>, firsts array<bigint>, entry int, dims int, vectors binary, single boolean, given binary, edges binary")


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = QUERY_BEAM) -> DataFrame:
    """(query row, class, its least id, score) of the k + 1 best classes found in every shard, for rows (query, vector).

    Queries go to the shards in blocks of bounded size, each with a copy of the shard's index.
    """
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("query", "vector"), F.lit(blocks)).cast("int"))
    keyed = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    last = index.agg(F.max("shard")).first()[0] or 0
    dealt = dealt.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last))))

    def run(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if shard.empty or asked.empty:
            return pd.DataFrame({"query": [], "class": [], "first": [], "score": []})
        row = shard.iloc[0]
        vectors = np.frombuffer(row["vectors"], np.float32).reshape(-1, row["dims"] + 1)
        given = np.frombuffer(row["given"], np.float32 if row["single"] else np.float64).reshape(-1, row["dims"])
        edges = np.frombuffer(row["edges"], "<i4").reshape(len(vectors), -1).astype(np.int64)
        names, firsts = np.array(list(row["classes"]), object), np.array(list(row["firsts"]), np.int64)
        out = []
        for lo in range(0, len(asked), BATCH):
            part = asked.iloc[lo:lo + BATCH]
            own = np.array(part["vector"].tolist(), np.float64)
            if own.shape[1] != row["dims"]:
                raise ValueError("vectors of different lengths")
            scaled = (own / np.abs(own).max(axis=1, keepdims=True)).astype(np.float32)
            lifted = np.concatenate([scaled, np.zeros((len(own), 1), np.float32)], 1)
            ids, _ = beam_search(vectors, edges, int(row["entry"]), lifted, beam)
            exact = np.einsum("ijk,ik->ij", given[ids].astype(np.float64), own)
            exact[ids < 0] = -np.inf
            order = np.lexsort((np.where(ids >= 0, firsts[ids], 0), -exact), axis=1)
            ids, exact = np.take_along_axis(ids, order, 1), np.take_along_axis(exact, order, 1)
            kept_ids, kept_scores = list(ids[:, :k + 1]), list(exact[:, :k + 1])
            if ids.shape[1] > k + 1:
                for i in np.flatnonzero(np.isfinite(exact[:, k + 1]) & (exact[:, k + 1] == exact[:, k])):
                    def score(nodes, q=own[i]):
                        return np.einsum("jk,k->j", given[nodes].astype(np.float64), q)

                    tied = with_ties(edges, ids[i][exact[i] >= exact[i, k]], exact[i, k], score)
                    scores = score(tied)
                    best = np.lexsort((firsts[tied], -scores))[:k + 1]
                    kept_ids[i], kept_scores[i] = tied[best], scores[best]
            counts = [len(x) for x in kept_ids]
            node, value = np.concatenate(kept_ids), np.concatenate(kept_scores)
            ok = np.isfinite(value) & (node >= 0)
            out.append(pd.DataFrame({"query": np.repeat(part["query"].to_numpy(), counts)[ok], "class": names[node[ok]],
                                     "first": firsts[node[ok]], "score": value[ok]}))
        return pd.concat(out)

    return keyed.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block")).applyInPandas(
        run, "query long, class string, first long, score double")


def nearest(vectors: DataFrame, k: int = 20, is_query: F.Column | None = None, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for every query row among all other rows."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"),
                          (F.lit(True) if is_query is None else F.coalesce(is_query, F.lit(False))).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    firsts, members = classes_of(rows, k)
    index = cut(build_index(firsts, shard_rows))
    queries = cut(rows.where("asks").select(F.col("id").alias("query"), "vector"))
    found = search(index, queries.distinct(), k)
    per_query = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    best = found.withColumn("r", F.row_number().over(per_query)).where(F.col("r") <= k + 1)
    # a class at the edge may tie with others: members are ranked by score, then id
    hits = best.select("query", "class", "score").join(members, "class").where("id <> query")
    ranks = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), 20, F.col("vec_id") % 20 == 0)
