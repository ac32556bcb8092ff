"""Exact top-N most similar tickets by cosine (OUT-8: JN-5, VEC-1..3, WIN-2/3, JN-6/7).

Plan (all distributed, no pair table is ever materialised):

1. Only ticket id, category and vector travel through the pair work.
2. Collapse exact copies of a row into one row with a multiplicity ``_m``
   (partial aggregation: a hot group of copies costs one row, not a hot task).
3. Hash every distinct row into one of B blocks; send each row to the
   B block pairs {b, j}. A pair task holds two blocks (about 2·N/B vectors).
4. ``applyInPandas`` per block pair: read the rows batch by batch, normalise
   once, one matrix product, and keep each row's best ``top_n`` distinct
   partners from the other block (self and same-id partners excluded, SEM-14).
   Only candidates leave the task, some rows at a time.
5. Final ``row_number`` over (score key desc, matched id asc) per left row,
   after expanding each candidate by its multiplicity; then the summaries are
   looked up for the N·top_n result rows (one deduplicated lookup of the
   enrichment), and each left row is emitted once per copy.

Work is exact: N²·d multiply-adds in BLAS, N·B·top_n candidate rows shuffled.
B grows with N (``block_rows`` rows per block); inside a task the blocks are
scored in tiles of at most SCORE_CELLS scores, and of each tile only what beats
a row's top_n so far is kept, so memory is bounded by the block data plus a
tile, whatever N is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.config import materialize

_CANDIDATE_SCHEMA = T.StructType([
    T.StructField("_uid", T.LongType()),
    T.StructField("_m", T.LongType()),
    T.StructField("ticket_id", T.StringType()),
    T.StructField("ticket_issue_category", T.StringType()),
    T.StructField("_ruid", T.LongType()),
    T.StructField("_mr", T.LongType()),
    T.StructField("matched_ticket_id", T.StringType()),
    T.StructField("matched_issue_category", T.StringType()),
    T.StructField("_score", T.DoubleType()),
    T.StructField("_key", T.DoubleType()),
])

_PLAIN = ["_uid", "_m", "ticket_id", "issue_category"]

# Scores are ranked on this many decimals so that equal vectors compare equal
# whatever the block shape did to the last bits of the product (SEM-13).
RANK_DECIMALS = 12
KEY_STEP = 10.0 ** -RANK_DECIMALS  # scores of one key lie no further apart
SCORE_CELLS = 2_000_000  # doubles of one score matrix: 16 MB
OFFER_CELLS = 250_000  # scores that are looked through at a time: where all tie, each takes some 100 bytes
ROWS_AT_ONCE = 8192  # vectors that are copied and normalised at a time


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    """Vectors as rows, in one copy; a null or shorter vector is filled up with zeros."""
    mat = np.zeros((len(vectors), dim), dtype=np.float64)
    for lo in range(0, len(vectors), ROWS_AT_ONCE):
        part = vectors.iloc[lo:lo + ROWS_AT_ONCE]
        lengths = np.fromiter((len(v) if v is not None else 0 for v in part), np.int64, len(part))
        if lengths.any():
            flat = np.concatenate([v for v in part if v is not None and len(v)])
            row = np.repeat(np.arange(len(part)), lengths)
            mat[lo + row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return mat


def _unit_rows(mat: np.ndarray) -> np.ndarray:
    """The rows at length one, written over ``mat``; a row of length zero gets zeros."""
    for lo in range(0, len(mat), ROWS_AT_ONCE):
        part = mat[lo:lo + ROWS_AT_ONCE]
        norms = np.sqrt(np.einsum("ij,ij->i", part, part))
        part /= np.where(norms == 0, 1.0, norms)[:, None]
        part[norms == 0] = 0.0
    return mat


def _exceeding(scores: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the scores above their row's limit, found in the order the matrix lies in memory."""
    if scores.flags.c_contiguous:
        at, col = np.divmod(np.flatnonzero(scores > limit[:, None]), max(1, scores.shape[1]))
    else:
        col, at = np.divmod(np.flatnonzero(scores.T > limit), max(1, scores.shape[0]))
    return at, col


class _Best:
    """The ``top_n`` best partners of every row so far: key, score and place of each, best first; place -1 is a free one.

    Partners stand in the order ties are settled in (id, then uid) and must be offered in that order, so one that only
    equals the worst kept key comes too late. Memory is rows x top_n, however many partners are offered.
    """

    def __init__(self, rows: int, top_n: int):
        self.top_n = top_n
        self.key = np.full((rows, top_n), -np.inf)
        self.score = np.full((rows, top_n), np.nan)
        self.place = np.full((rows, top_n), -1, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray, partner_ids: np.ndarray, row: int, place: int) -> None:
        """A matrix of scores of the rows from ``row`` on with the partners from ``place`` on; equal ids don't match.

        Some rows at a time, as every score of the matrix can be one to look at (ties, or each above the row's limit)."""
        rows = max(1, OFFER_CELLS // max(1, scores.shape[1]))
        for lo in range(0, len(scores), rows):
            self._offer_rows(scores[lo:lo + rows], ids[lo:lo + rows], partner_ids, row + lo, place)

    def _offer_rows(self, scores: np.ndarray, ids: np.ndarray, partner_ids: np.ndarray, row: int, place: int) -> None:
        n = len(scores)
        full = self.place[row:row + n, -1] >= 0
        # a score that rounds to a greater key exceeds the worst kept key by half a step at least
        at, col = _exceeding(scores, np.where(full, self.key[row:row + n, -1] + KEY_STEP / 4, np.inf))
        differ = ids[at] != partner_ids[col]
        at, col = at[differ], col[differ]
        short = np.flatnonzero(~full)
        if short.size:  # rows with a free place: what reaches their k-th best of this matrix
            valid = ids[short][:, None] != partner_ids[None, :]
            masked = np.where(valid & ~np.isnan(scores[short]), scores[short], -np.inf)
            k = min(self.top_n, masked.shape[1])
            kth = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
            more_at, more_col = np.nonzero(valid & (masked >= (kth - 2 * KEY_STEP)[:, None]))
            at, col = np.concatenate([at, short[more_at]]), np.concatenate([col, more_col])
        if at.size:
            self._merge(row + at, scores[at, col], place + col)

    def _merge(self, at: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
        key = np.round(score, RANK_DECIMALS)
        key[np.isnan(key)] = -np.inf
        rows = np.unique(at)
        held = self.place[rows] >= 0
        at = np.concatenate([np.repeat(rows, held.sum(axis=1)), at])
        key = np.concatenate([self.key[rows][held], key])
        score = np.concatenate([self.score[rows][held], score])
        place = np.concatenate([self.place[rows][held], place])
        order = np.lexsort((place, -key, at))
        at = at[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        kept = rank < self.top_n
        at, rank, order = at[kept], rank[kept], order[kept]
        self.key[at, rank], self.score[at, rank], self.place[at, rank] = key[order], score[order], place[order]

    def frame(self, left: pd.DataFrame, right: pd.DataFrame, start: int = 0, end: int | None = None) -> pd.DataFrame:
        """The kept pairs of ``left``'s rows (from ``start`` to before ``end``) with their partners in ``right``."""
        rows, at = np.nonzero(self.place[start:end] >= 0)
        rows += start
        cols = self.place[rows, at]
        return pd.DataFrame({
            "_uid": left["_uid"].to_numpy()[rows],
            "_m": left["_m"].to_numpy()[rows],
            "ticket_id": left["ticket_id"].to_numpy()[rows],
            "ticket_issue_category": left["issue_category"].to_numpy()[rows],
            "_ruid": right["_uid"].to_numpy()[cols],
            "_mr": right["_m"].to_numpy()[cols],
            "matched_ticket_id": right["ticket_id"].to_numpy()[cols],
            "matched_issue_category": right["issue_category"].to_numpy()[cols],
            "_score": self.score[rows, at],
            "_key": self.key[rows, at],
        })


def _codes(left: pd.DataFrame, right: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the ticket ids of both sides, equal for equal ids."""
    ids = pd.factorize(pd.concat([left["ticket_id"], right["ticket_id"]], ignore_index=True))[0]
    return ids[:len(left)], ids[len(left):]


def _best_partners(left: pd.DataFrame, right: pd.DataFrame, scores: np.ndarray, top_n: int) -> pd.DataFrame:
    """For each left row, its ``top_n`` best right rows (distinct rows) by a whole matrix of scores."""
    best = _Best(len(left), top_n)
    if scores.size:
        best.offer(scores, *_codes(left, right), 0, 0)
    return best.frame(left, right)


def _score_blocks(left: pd.DataFrame, right: pd.DataFrame, ul: np.ndarray, ur: np.ndarray, top_n: int,
                  chunk_rows: int, both: bool) -> tuple[_Best, _Best]:
    """Score at most ``chunk_rows`` left rows with at most SCORE_CELLS / ``chunk_rows`` right rows at a time; each product
    serves both directions when ``both``. Only the best so far stay from one product to the next."""
    lid, rid = _codes(left, right)
    forward, backward = _Best(len(left), top_n), _Best(len(right) if both else 0, top_n)
    width = max(1, SCORE_CELLS // max(1, chunk_rows))
    for a in range(0, len(left), chunk_rows):
        for b in range(0, len(right), width):
            scores = ul[a:a + chunk_rows] @ ur[b:b + width].T
            forward.offer(scores, lid[a:a + chunk_rows], rid[b:b + width], a, b)
            if both:
                backward.offer(scores.T, rid[b:b + width], lid[a:a + chunk_rows], b, a)
    return forward, backward


def _block_pair(left: pd.DataFrame, right: pd.DataFrame, ul: np.ndarray, ur: np.ndarray, top_n: int,
                chunk_rows: int, both: bool) -> list[pd.DataFrame]:
    """The best pairs of two blocks, and of the second with the first when ``both``."""
    forward, backward = _score_blocks(left, right, ul, ur, top_n, chunk_rows, both)
    found = [forward.frame(left, right)] + ([backward.frame(right, left)] if both else [])
    return [f for f in found if not f.empty]


def _blocks_of(batches: Iterator[pd.DataFrame]) -> list[tuple[pd.DataFrame, np.ndarray]]:
    """The one or two blocks of a group, as plain columns and unit vectors, in the order ties are settled in.

    Every vector is held once: a batch's vectors are copied to their rows when all rows are known, and go."""
    plain, vectors = [], []
    for batch in batches:
        # copies, as a view would keep the whole batch
        plain.append(pd.DataFrame({c: batch[c].to_numpy(copy=True) for c in ("_blk", *_PLAIN)}))
        vectors.append(_matrix(batch["embedding"], max((len(v) for v in batch["embedding"] if v is not None), default=0)))
        del batch
    rows = pd.concat(plain, ignore_index=True)
    rows = rows.sort_values(["ticket_id", "_uid"], kind="mergesort", na_position="first")
    dim = max(v.shape[1] for v in vectors)
    sides, place = [], np.zeros(len(rows), np.int64)  # by place of arrival
    for b in np.unique(rows["_blk"]):
        mine = rows[rows["_blk"] == b]
        place[mine.index] = np.arange(len(mine))
        sides.append((b, mine[_PLAIN].reset_index(drop=True), np.zeros((len(mine), dim))))
    blk = rows["_blk"].sort_index().to_numpy()
    del rows
    end = len(blk)
    while vectors:
        part = vectors.pop()
        at = slice(end - len(part), end)
        for b, _, mat in sides:
            mine = blk[at] == b
            mat[place[at][mine], :part.shape[1]] = part[mine]
        end -= len(part)
    return [(frame, _unit_rows(mat)) for _, frame, mat in sides]


def _pair_kernel(top_n: int, chunk_rows: int):
    def kernel(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = key[0] == key[1]
        sides = _blocks_of(batches)
        if len(sides) == 1 and not whole:  # the other block has no rows
            return
        (left, ul), (right, ur) = sides[0], sides[-1]
        forward, backward = _score_blocks(left, right, ul, ur, top_n, chunk_rows, both=not whole)
        for best, mine, other in ((forward, left, right), (backward, right, left))[:1 if whole else 2]:
            for lo in range(0, len(mine), ROWS_AT_ONCE):
                yield best.frame(mine, other, lo, lo + ROWS_AT_ONCE)

    return kernel


def choose_blocks(n_rows: int, block_rows: int, parallelism: int) -> int:
    """Blocks so that a block holds at most ``block_rows`` rows, and the block
    pairs give every core work."""
    by_size = math.ceil(max(n_rows, 1) / max(block_rows, 1))
    by_cores = math.ceil((math.sqrt(8 * max(parallelism, 1) + 1) - 1) / 2)
    return max(1, min(max(by_size, by_cores), max(n_rows, 1)))


def summary_lookup(enrichment: DataFrame) -> DataFrame:
    """One (customer_summary, next_best_action) per ticket_id (JN-6/7 lookup).

    Duplicate ids collapse to one deterministic record by aggregation (map-side
    partial aggregation, so a hot id never lands whole on one task)."""
    rec = F.struct(F.col("customer_summary"), F.col("next_best_action"))
    order = F.struct(F.col("created_at"), F.col("customer_summary"), F.col("next_best_action"))
    return (
        enrichment.groupBy("ticket_id")
        .agg(F.max_by(rec, order).alias("_r"))
        .select("ticket_id", "_r.customer_summary", "_r.next_best_action")
    )


def _all_block_pairs(distinct: DataFrame, top_n: int, block_rows: int, num_blocks: int | None, n_rows: int | None,
                     chunk_rows: int) -> DataFrame:
    """Candidate pairs from every pair of hashed blocks."""
    if num_blocks is None:
        if n_rows is None:
            distinct = materialize(distinct)  # counted, then read by the pairs
            n_rows = distinct.count()
        num_blocks = choose_blocks(n_rows, block_rows, distinct.sparkSession.sparkContext.defaultParallelism)
    b = int(num_blocks)
    staged = (
        distinct.withColumn("_blk", F.pmod(F.col("_uid"), F.lit(b)).cast("int"))
        .withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(b - 1))))
        .withColumn("_bi", F.least("_blk", "_j"))
        .withColumn("_bj", F.greatest("_blk", "_j"))
        .drop("_j")
    )
    return staged.groupBy("_bi", "_bj").applyInPandas(_pair_kernel(top_n, chunk_rows), _CANDIDATE_SCHEMA)


def top_matches(embeddings: DataFrame, enrichment: DataFrame | None = None, top_n: int = 3,
                block_rows: int = 100_000, num_blocks: int | None = None, n_rows: int | None = None,
                chunk_rows: int = 1024, copy_chunk: int = 100_000, require_summaries: bool = False,
                pivots: int | None = None, stats: dict | None = None) -> DataFrame:
    """OUT-8: for every embedding row, its ``top_n`` most similar other tickets.

    ``embeddings``: ticket_id, issue_category, embedding (array of numbers).
    ``enrichment``: ticket_id, customer_summary, next_best_action[, created_at]
    for the summary lookups; without it those columns are null.
    ``n_rows``: an upper bound of the row count, used only to size the blocks (too
    small a number makes them, and a task's memory, larger than ``block_rows``);
    when absent the distinct rows are stored and counted.
    ``block_rows`` sets the replication (each row travels to N / block_rows
    block pairs; 100,000 rows of 64 doubles are 51 MB); ``chunk_rows`` and SCORE_CELLS bound a task's score matrix,
    independently of the block size.
    ``require_summaries``: a result row whose id the enrichment doesn't have fails the job, as at the source; else its
    summary columns are null.
    ``pivots``: compare a row only with blocks that can hold one of its best (``operators.pivots``), the same rows with
    less work where vectors lie in clusters; ``stats`` then receives the blocks visited and skipped.
    """
    emb = embeddings.select(
        "ticket_id", "issue_category", F.col("embedding").cast("array<double>").alias("embedding"))
    content = ["ticket_id", "issue_category", "embedding"]
    distinct = emb.groupBy(*content).agg(F.count(F.lit(1)).alias("_m"))
    distinct = distinct.withColumn("_uid", F.xxhash64(*content))

    if pivots:
        from caseloom.operators.pivots import candidates as pruned

        candidates = pruned(distinct, top_n, block_rows, pivots, chunk_rows, stats)
    else:
        candidates = _all_block_pairs(distinct, top_n, block_rows, num_blocks, n_rows, chunk_rows)

    # a partner with several identical copies fills up to top_n slots
    expanded = candidates.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.least(F.col("_mr"), F.lit(top_n)))))
    w = Window.partitionBy("_uid", "ticket_id").orderBy(
        F.col("_key").desc(), F.col("matched_ticket_id").asc(), F.col("_ruid").asc(), F.col("_copy").asc())
    ranked = expanded.withColumn("similarity_rank", F.row_number().over(w)).filter(
        F.col("similarity_rank") <= top_n)
    # summaries join the N·top_n results, not the N·B replicated rows (JN-6/7)
    if enrichment is not None:
        if "created_at" not in enrichment.columns:
            enrichment = enrichment.withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
        lookup = summary_lookup(enrichment)
        if require_summaries:
            have = lookup.select(F.col("ticket_id").alias("_have"))
            for side in ("ticket_id", "matched_ticket_id"):
                unknown = F.raise_error(F.concat(F.lit("no enrichment for ticket "), F.coalesce(F.col(side), F.lit("?"))))
                ranked = ranked.join(have, F.col(side) == F.col("_have"), "left").filter(
                    F.when(F.col("_have").isNull(), unknown.cast("boolean")).otherwise(True)).drop("_have")
        ranked = (
            ranked.join(lookup.select("ticket_id", F.col("customer_summary").alias("ticket_summary")),
                        "ticket_id", "left")
            .join(lookup.select(F.col("ticket_id").alias("matched_ticket_id"),
                                F.col("customer_summary").alias("matched_ticket_summary"),
                                F.col("next_best_action").alias("recommended_action_pattern")),
                  "matched_ticket_id", "left")
        )
    else:
        ranked = ranked.withColumns({c: F.lit(None).cast("string") for c in
                                     ("ticket_summary", "matched_ticket_summary", "recommended_action_pattern")})
    out = _emit_copies(ranked, copy_chunk)
    return out.select(
        "ticket_id", "matched_ticket_id", "ticket_issue_category", "matched_issue_category",
        F.col("similarity_rank").cast("int").alias("similarity_rank"),
        F.round(F.col("_score"), 6).alias("similarity_score"),
        "ticket_summary", "matched_ticket_summary", "recommended_action_pattern",
    )


def _emit_copies(ranked: DataFrame, chunk: int) -> DataFrame:
    """One output row per copy of each left row.

    Rows are cut into pieces of at most ``chunk`` copies (most are one piece) and the pieces are spread over tasks,
    so no task emits the whole of a large group of identical rows."""
    pieces = ranked.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("_m") - 1) / chunk))))
    return pieces.repartition("_uid", "_piece", "similarity_rank").withColumn(
        "_rep", F.explode(F.sequence(F.lit(1), F.least(F.lit(chunk), F.col("_m") - F.col("_piece") * chunk)))).drop("_piece")


def top_similarity(similarity: DataFrame) -> DataFrame:
    """WIN-1/FLT-5: the best-ranked match per ticket (ties → smaller matched id).

    An aggregate (min_by) rather than a window: partial aggregation runs before
    the shuffle, so a hot ticket id is reduced map-side."""
    best = F.min_by(
        F.struct("matched_ticket_id", "similarity_score", "similarity_rank"),
        F.struct("similarity_rank", "matched_ticket_id", "similarity_score"),
    )
    return (
        similarity.groupBy("ticket_id").agg(best.alias("_b"))
        .select("ticket_id", "_b.matched_ticket_id", "_b.similarity_score", "_b.similarity_rank")
    )
