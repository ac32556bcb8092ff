"""Sharding: a uniform shuffle into shards whose sizes are exact, by a hypergeometric communication matrix.

Shard sizes are fixed first (they differ by one row at most). How many rows of each input partition go to each shard is
then drawn exactly as a uniform shuffle would have it: a multivariate hypergeometric law over the shards' free places.
The draws form a tree over the partitions (how many of the left half's rows go to each shard, and so on down), each
node with its own seed, so a task draws its own row of the matrix along its path and no place holds the matrix. A task
permutes its rows locally, batch by batch, by the same law; rows are then exchanged by shard, and a random key per row,
range-sorted within the shard, permutes them again. Draws depend on seeds and on the checkpointed order of the rows
only, so a retried task draws alike, and shards of any size are dealt over many tasks.

Results for odd input: null, empty and very long texts are rows like others (sizes don't steer the law); repeated rows
and null ids have places of their own; an empty table gives no rows; fewer rows than shards leave shards empty; input
columns named like the two results are replaced by them, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.frames import cut, ranked, table

SHARDS, SEED = 24, 12
_REACH = 12  # standard deviations around the mode that a draw looks at; beyond lies less than a double can tell


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    return rows // shards + (np.arange(shards) < rows % shards).astype(np.int64)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` places out of ``good + bad`` are good. Any size: the law is summed up around its mode."""
    lo, hi = max(0, drawn - bad), min(drawn, good)
    if lo == hi:
        return lo
    total = good + bad
    share = good / total
    mode = min(hi, max(lo, (drawn + 1) * (good + 1) // (total + 2)))
    reach = int(_REACH * (drawn * share * (1 - share) * (total - drawn) / max(total - 1, 1)) ** 0.5) + 50
    k = np.arange(max(lo, mode - reach), min(hi, mode + reach) + 1, dtype=np.float64)
    steps = np.log((good - k[:-1]) * (drawn - k[:-1])) - np.log((k[:-1] + 1) * (bad - drawn + k[:-1] + 1))
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    law = np.cumsum(np.exp(logs - logs.max()))
    return int(k[np.searchsorted(law, rng.random() * law[-1], "right")])


def spread(rng: np.random.Generator, places: np.ndarray, drawn: int) -> np.ndarray:
    """How many of ``drawn`` rows go to each shard, when every free place is as likely as any other."""
    out, rest = np.zeros(len(places), np.int64), int(places.sum())
    for s, free in enumerate(places.tolist()):
        rest -= free
        out[s] = hypergeometric(rng, free, rest, drawn)
        drawn -= int(out[s])
    return out


def matrix_row(part: int, starts: list[int], sizes: np.ndarray, seed: int) -> np.ndarray:
    """The row of the communication matrix of one partition; ``starts`` holds the rows before each, and the total."""
    lo, hi, places = 0, len(starts) - 1, sizes
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = spread(np.random.default_rng([seed, lo, hi]), places, starts[mid] - starts[lo])
        lo, hi, places = (lo, mid, left) if part < mid else (mid, hi, places - left)
    return places


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """The rows with their shard (from 0) and their slot in it (from 0, gapless)."""
    rows = cut(docs.drop(shard_col, slot_col)).withColumn("__in", F.spark_partition_id())
    counts = {r["__in"]: r["count"] for r in rows.groupBy("__in").count().collect()}  # a row per partition
    starts = list(accumulate((counts.get(p, 0) for p in range(max(counts, default=0) + 1)), initial=0))
    sizes = shard_sizes(starts[-1], shards)

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = places = None
        for b in batches:
            if b.num_rows == 0:
                continue
            if places is None:
                part = b.column(b.num_columns - 1)[0].as_py()
                rng, places = np.random.default_rng([seed, part]), matrix_row(part, starts, sizes, seed)
            here = spread(rng, places, b.num_rows)
            places = places - here
            to = rng.permutation(np.repeat(np.arange(shards, dtype=np.int32), here))
            keys = rng.integers(-1 << 63, (1 << 63) - 1, b.num_rows, dtype=np.int64, endpoint=True)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(to), pa.array(keys)], names=[*b.schema.names[:-1], "__shard", "__key"])

    schema = rows.drop("__in").withColumns({"__shard": F.lit(0), "__key": F.lit(0).cast("long")}).schema
    dealt = rows.mapInArrow(permute, schema)
    placed = ranked(dealt, [F.col("__shard"), F.col("__key")], "__slot", by=["__shard"]).drop("__key")
    return placed.withColumnsRenamed({"__shard": shard_col, "__slot": slot_col})


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """The shards as Parquet folders ``shard=N``, rows in the order of their slots; a large shard has several files."""
    placed = shard(docs, shards, seed)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                              F.lit(None).cast("int").alias("grown_shard"))
