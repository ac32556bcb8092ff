"""Fitted embeddings (UDF-2): TF-IDF vectors in the directions in which the corpus itself varies most.

Tokens are hashed into ``slots`` places (MD5). One pass counts in how many texts each place occurs; a text's row is its
token counts times the places' inverse document frequencies, at length 1. The leading right singular vectors of all
rows are found by block power iteration from a random projection: in a round every task multiplies its rows with the
current block and adds up what each place gets back, Spark adds the tasks' sums by place, and the driver makes the
block orthonormal again. The driver holds slots x (dim + spare) numbers, whatever the number of texts; no row leaves
its task. A text's vector is its row times the fitted directions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.config import materialize
from caseloom.operators.embed import tokens

SLOTS = 1 << 14
CHUNK = 1 << 15  # entries of the sparse rows multiplied at once
SEED = 2


def token_slots(text: Column, slots: int = SLOTS) -> Column:
    """array<int>: the place of every token, repeats kept."""
    return F.transform(tokens(text), lambda t: (F.conv(F.substring(F.md5(t.cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int"))


def term_weights(places: DataFrame, col: str = "places") -> DataFrame:
    """slot, texts, idf of every place that occurs, from rows with an array of places."""
    n = places.agg(F.count("*")).first()[0]
    counts = places.select(F.explode(F.array_distinct(F.col(col))).alias("slot")).groupBy("slot").agg(F.count("*").alias("texts"))
    return counts.withColumn("idf", F.log(F.lit(float(n + 1)) / (F.col("texts") + 1)) + 1)


def sparse_rows(flat: np.ndarray, lengths: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of the rows' TF-IDF entries, each row at length 1, by row and place."""
    key, count = np.unique(np.repeat(np.arange(len(lengths)), lengths) * len(idf) + flat, return_counts=True)
    row, place = key // len(idf), key % len(idf)
    value = count * idf[place]
    norm = np.sqrt(np.bincount(row, value * value, len(lengths)))
    norm[norm == 0] = 1.0  # tokens that the fitted texts don't have
    return row, place, value / norm[row]


def project(row: np.ndarray, place: np.ndarray, value: np.ndarray, n: int, basis: np.ndarray) -> np.ndarray:
    """The sparse rows times ``basis``."""
    out = np.zeros((n, basis.shape[1]))
    for lo in range(0, len(row), CHUNK):
        r, part = row[lo:lo + CHUNK], value[lo:lo + CHUNK, None] * basis[place[lo:lo + CHUNK]]
        first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
        out[r[first]] += np.add.reduceat(part, first, axis=0)
    return out


def back(row: np.ndarray, place: np.ndarray, value: np.ndarray, projected: np.ndarray, out: np.ndarray) -> None:
    """Add the transposed sparse rows times ``projected`` to ``out``."""
    order = np.argsort(place, kind="stable")
    for lo in range(0, len(order), CHUNK):
        o = order[lo:lo + CHUNK]
        p = place[o]
        first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        out[p[first]] += np.add.reduceat(value[o, None] * projected[row[o]], first, axis=0)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)


def _round(places: DataFrame, col: str, idf: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Transposed rows times rows times ``block``, added up over all texts."""
    width = block.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(block)
        for b in batches:
            flat, lengths = _lists(b.column(0))
            if len(flat):
                entries = sparse_rows(flat, lengths, idf)
                back(*entries, project(*entries, len(lengths), block), total)
        touched = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(touched.astype(np.int32)), *[pa.array(total[touched, c]) for c in range(width)]],
                                         names=["slot", *[f"c{c}" for c in range(width)]])

    sums = places.select(col).mapInArrow(add, "slot int, " + ", ".join(f"c{c} double" for c in range(width)))
    got = sums.groupBy("slot").agg(*[F.sum(f"c{c}").alias(f"c{c}") for c in range(width)]).toArrow()  # at most a row per place
    out = np.zeros_like(block)
    if got.num_rows:
        out[got.column("slot").to_numpy()] = np.column_stack([got.column(f"c{c}").to_numpy() for c in range(width)])
    return out


@dataclass
class LatentModel:
    """Inverse document frequencies, the fitted directions (a column each) and their singular values."""

    idf: np.ndarray
    basis: np.ndarray
    strength: np.ndarray

    def vector(self, text: Column) -> Column:
        """The text's vector, an Arrow batch at a time; a null text gives null, one without tokens zeros."""
        idf, basis = self.idf, self.basis

        @F.pandas_udf("array<double>")
        def embed(lists: pd.Series) -> pd.Series:
            lengths = np.fromiter((0 if x is None else len(x) for x in lists), np.int64, len(lists))
            flat = np.concatenate([x for x in lists if x is not None and len(x)]).astype(np.int64) if lengths.sum() else np.zeros(0, np.int64)
            out = project(*sparse_rows(flat, lengths, idf), len(lengths), basis)
            return pd.Series([v if x is not None else None for v, x in zip(out, lists)], index=lists.index, dtype=object)

        return embed(token_slots(text, len(idf)))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, float(self.idf[i]), self.basis[i].tolist()) for i in range(len(self.idf))]
        spark.createDataFrame(rows, "slot int, idf double, direction array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/places")
        spark.createDataFrame([(i, float(s)) for i, s in enumerate(self.strength)], "place int, strength double").coalesce(
            1).write.mode("overwrite").parquet(f"{path}/strength")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LatentModel:
        rows = sorted(spark.read.parquet(f"{path}/places").collect())
        strength = [r[1] for r in sorted(spark.read.parquet(f"{path}/strength").collect())]
        return LatentModel(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), np.array(strength))


def fit(texts: DataFrame, text: Column, dim: int = 64, rounds: int = 8, spare: int = 8, slots: int = SLOTS) -> LatentModel:
    """The ``dim`` leading directions of the texts' TF-IDF rows. ``spare`` more are iterated along, which speeds it up.

    Directions beyond the corpus' rank are zero, so a small corpus still gives vectors of length ``dim``.
    """
    places = materialize(texts.select(token_slots(text, slots).alias("places")))
    idf = np.zeros(slots)
    weights = term_weights(places).toArrow()  # at most a row per place
    idf[weights.column("slot").to_numpy()] = weights.column("idf").to_numpy()
    width = min(slots, dim + spare)
    block = np.linalg.qr(np.random.default_rng(SEED).normal(size=(slots, width)))[0]
    for _ in range(rounds):
        block = np.linalg.qr(_round(places, "places", idf, block))[0]
    last = _round(places, "places", idf, block)
    power, turn = np.linalg.eigh((block.T @ last + last.T @ block) / 2)
    order = np.argsort(-power)[:dim]
    strength = np.sqrt(np.maximum(power[order], 0))
    basis = block @ turn[:, order]
    real = strength > 1e-7 * max(float(strength[0]) if len(strength) else 0.0, 1e-300)
    basis[:, ~real], strength[~real] = 0.0, 0.0
    sign = np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])])  # the largest entry of a direction is positive
    basis = np.pad(basis * np.where(sign == 0, 1, sign), ((0, 0), (0, dim - basis.shape[1])))
    return LatentModel(idf, basis, np.pad(strength, (0, dim - len(strength))))
