"""Exact candidates for the most similar tickets, without reading blocks that cannot hold one (VEC-2, JN-5).

Rows are dealt to the nearest of a few pivots and cells are cut into blocks, so a block's rows lie close together. For
every block the least and greatest angle of its rows to every pivot are kept: the metric table. A row is first compared
with its own block; the score of its ``top_n``-th best partner there is a floor. By the triangle inequality of angles
no row of another block can be nearer to it than the gap between the row's angle to a pivot and the block's range of
angles to that pivot, for any pivot. Blocks whose bound stays below the floor are skipped; the row visits the others.
Nothing is approximate: ties at the floor are visited, and rows without a direction (null, zero or not finite) are
compared with every block.

Pivots come from a bounded sample (``SAMPLE`` rows, the farthest from one another first); they steer only how much is
skipped. Driver and tasks hold pivots x blocks numbers. A block's visitors are dealt to as many tasks as they fill.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.config import materialize
from caseloom.operators import similarity as S

SAMPLE = 2048
ANGLE_SLACK, SCORE_SLACK = 1e-7, 1e-9  # rounding of angles, and of scores that are compared on 12 decimals

_ROW = [T.StructField("_uid", T.LongType()), T.StructField("_m", T.LongType()), T.StructField("ticket_id", T.StringType()),
        T.StructField("issue_category", T.StringType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))]
_FOUND = T.StructType([*_ROW, T.StructField("_targets", T.ArrayType(T.IntegerType())),
                       T.StructField("_near", T.ArrayType(S._CANDIDATE_SCHEMA))])


def choose_pivots(distinct: DataFrame, pivots: int, dim: int) -> np.ndarray:
    """Unit vectors of a sample by farthest-first order; fewer if the sample has fewer directions."""
    some = distinct.where(F.exists("embedding", lambda x: x != 0)).orderBy("_uid").limit(SAMPLE).select("embedding").toPandas()
    unit = S._unit_rows(S._matrix(some["embedding"], dim))
    unit = unit[np.isfinite(unit).all(axis=1)]
    chosen: list[int] = []
    best = np.full(len(unit), -2.0)
    while len(chosen) < min(pivots, len(unit)):
        i = 0 if not chosen else int(best.argmin())
        if chosen and best[i] > 1 - 1e-9:
            break
        chosen.append(i)
        best = np.maximum(best, unit @ unit[i])
    return unit[chosen]


def _angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))


def _with_cells(distinct: DataFrame, pivots: np.ndarray, dim: int) -> DataFrame:
    """The rows with ``_cell``, their nearest pivot (-1: no direction), and ``_angles`` to all pivots."""
    def place(frames):
        for pdf in frames:
            unit = S._unit_rows(S._matrix(pdf["embedding"], dim))
            plain = np.isfinite(unit).all(axis=1) & unit.any(axis=1)
            angles = _angles(np.where(plain[:, None], unit, 0.0), pivots) if len(pivots) else np.zeros((len(pdf), 0))
            cell = angles.argmin(axis=1) if len(pivots) else np.full(len(pdf), -1)
            yield pdf.assign(_cell=np.where(plain, cell, -1).astype(np.int32), _angles=[a if p else None for a, p in zip(angles, plain)])

    schema = T.StructType([*_ROW, T.StructField("_cell", T.IntegerType()), T.StructField("_angles", T.ArrayType(T.DoubleType()))])
    return distinct.select(*[f.name for f in _ROW]).mapInPandas(place, schema)


class MetricTable:
    """Blocks and the range of their rows' angles to every pivot; an open range for rows without a direction."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low, high

    def bounds(self, angles: np.ndarray) -> np.ndarray:
        """(rows, blocks): the greatest score a row can have with any row of a block."""
        gap = np.zeros((len(angles), len(self.low)))
        for p in range(self.low.shape[1]):
            a = angles[:, p:p + 1]
            np.maximum(gap, np.maximum(self.low[:, p] - a, a - self.high[:, p]), out=gap)
        return np.cos(np.maximum(gap - ANGLE_SLACK, 0.0)) + SCORE_SLACK


def _blocks(cells: DataFrame, block_rows: int, pivots: int) -> tuple[DataFrame, MetricTable]:
    """Rows with their block ``_blk``, and the metric table; one row per cell, then one per block, reach the driver."""
    sizes = {r["_cell"]: r["count"] for r in cells.groupBy("_cell").count().collect()}
    first, parts, at = {}, {}, 0
    for c in sorted(sizes):
        first[c], parts[c] = at, max(1, math.ceil(sizes[c] / block_rows))
        at += parts[c]

    def of(table: dict[int, int]):
        return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.col("_cell"))

    rows = cells.withColumn("_blk", (of(first) + F.pmod(F.xxhash64("_uid", F.lit("part")), of(parts))).cast("int")) if sizes else \
        cells.withColumn("_blk", F.lit(0))
    ranges = rows.groupBy("_blk").agg(F.count_if(F.col("_angles").isNull()).alias("odd"), *[
        f(F.get("_angles", F.lit(p))).alias(f"{n}{p}") for p in range(pivots) for n, f in (("lo", F.min), ("hi", F.max))]).collect()
    low, high = np.zeros((at, pivots)), np.full((at, pivots), np.pi)
    for r in ranges:
        if not r["odd"]:
            low[r["_blk"]] = [r[f"lo{p}"] for p in range(pivots)]
            high[r["_blk"]] = [r[f"hi{p}"] for p in range(pivots)]
    return rows, MetricTable(low, high)


def _scored(left: pd.DataFrame, right: pd.DataFrame, top_n: int, chunk_rows: int) -> pd.DataFrame:
    """Each left row's best right rows; ``right`` stands in the order ties are settled in."""
    dim = max((len(v) for f in (left, right) for v in f["embedding"] if v is not None), default=0)
    ul, ur = S._unit_rows(S._matrix(left["embedding"], dim)), S._unit_rows(S._matrix(right["embedding"], dim))
    parts = S._block_pair(left, right, ul, ur, top_n, chunk_rows, both=False)
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=S._CANDIDATE_SCHEMA.names)


def _own_block(table: MetricTable, top_n: int, chunk_rows: int):
    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ticket_id", "_uid"], kind="mergesort", na_position="first").reset_index(drop=True)
        found = _scored(pdf, pdf, top_n, chunk_rows)
        # rows are told apart by their place: two with one id and uid would be equal rows, which were collapsed
        place = {k: i for i, k in enumerate(zip(pdf["_uid"], pdf["ticket_id"]))}
        near: list[list[dict]] = [[] for _ in range(len(pdf))]
        floor = np.full(len(pdf), -np.inf)
        for rec in found.to_dict("records"):
            near[place[rec["_uid"], rec["ticket_id"]]].append(rec)
        for i, recs in enumerate(near):
            if len(recs) >= top_n:
                floor[i] = sorted((r["_key"] for r in recs), reverse=True)[top_n - 1]
        blk = int(pdf["_blk"].iloc[0])
        angles = np.array([a if a is not None else np.zeros(table.low.shape[1]) for a in pdf["_angles"]], dtype=np.float64).reshape(len(pdf), -1)
        odd = pdf["_angles"].isna().to_numpy()
        targets = []
        for lo in range(0, len(pdf), chunk_rows):
            reach = (table.bounds(angles[lo:lo + chunk_rows]) >= floor[lo:lo + chunk_rows, None]) | odd[lo:lo + chunk_rows, None]
            reach[:, blk] = False
            targets += [np.flatnonzero(r).astype(np.int32) for r in reach]
        return pdf[[f.name for f in _ROW]].assign(_targets=targets, _near=near)

    return kernel


def _visits(top_n: int, chunk_rows: int):
    columns = S._CANDIDATE_SCHEMA.names

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ticket_id", "_uid"], kind="mergesort", na_position="first")
        left, right = (pdf[pdf["_visitor"] == v].reset_index(drop=True) for v in (True, False))
        return _scored(left, right, top_n, chunk_rows)[columns] if len(left) and len(right) else pd.DataFrame(columns=columns)

    return kernel


def candidates(distinct: DataFrame, top_n: int, block_rows: int = 100_000, pivots: int = 32,
               chunk_rows: int = 1024, stats: dict | None = None) -> DataFrame:
    """Candidate pairs that hold every row's exact ``top_n``, for distinct rows (_uid, _m, ticket_id, issue_category,
    embedding). ``stats`` receives the numbers of blocks, rows, and row-to-block visits made and skipped."""
    size = distinct.agg(F.max(F.size("embedding")).alias("dim"), F.count("*").alias("rows")).first()
    chosen = choose_pivots(distinct, pivots, size["dim"] or 0) if size["dim"] and size["dim"] > 0 else np.zeros((0, 0))
    cells = materialize(_with_cells(distinct, chosen, max(size["dim"] or 0, 0)))
    rows, table = _blocks(cells, block_rows, len(chosen))
    found = materialize(rows.groupBy("_blk").applyInPandas(_own_block(table, top_n, chunk_rows), _FOUND))

    names = [f.name for f in _ROW]
    visitors = found.select(*names, F.explode("_targets").alias("_blk"))
    per_block = {r["_blk"]: r["count"] for r in visitors.groupBy("_blk").count().collect()}  # a row per block
    if stats is not None:
        blocks, made = len(table.low), sum(per_block.values())
        stats.update(blocks=blocks, rows=size["rows"], visits=made, skipped=size["rows"] * max(blocks - 1, 0) - made)
    near = found.select(F.explode("_near").alias("c")).select("c.*")
    if not per_block:
        return near
    pieces = distinct.sparkSession.createDataFrame(
        [(b, math.ceil(n / block_rows)) for b, n in sorted(per_block.items())], "_blk int, _pieces int")
    left = visitors.join(pieces, "_blk").select(*names, "_blk", F.pmod(F.xxhash64("_uid"), F.col("_pieces")).cast("int").alias("_piece"),
                                                F.lit(True).alias("_visitor"))
    right = rows.select(*names, "_blk").join(pieces, "_blk").select(
        *names, "_blk", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)).alias("_piece"), F.lit(False).alias("_visitor"))
    met = left.unionByName(right).groupBy("_blk", "_piece").applyInPandas(_visits(top_n, chunk_rows), S._CANDIDATE_SCHEMA)
    return near.unionByName(met)
