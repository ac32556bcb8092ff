"""Document fingerprints by winnowing: the smallest rolling hash of every window of k-grams, with its position.

Two texts that share ``gram + window - 1`` consecutive code points share a fingerprint. Of equal minima in a window
the rightmost is chosen. Positions are kept, so a shared fingerprint can be traced to both texts.

Results for odd input: null text counts as empty and has no fingerprint; a text shorter than a k-gram is one gram;
equal texts have equal fingerprints; the likeness of two empty fingerprints is 1, of an empty and another 0. For the
next document, rows are ordered by id (null first), then text; repeated ids follow each other; a single row is its own
next one; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.frames import table
from caseloom.llm.hashing import INVERSE, U, mix, powers, slide_min

GRAM = 16
WINDOW = 48


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hashes, positions) chosen from a text, in order of position."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(points)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    k = min(gram, n)
    sums = np.zeros(n + 1, U)
    np.cumsum((points.astype(U) + U(1)) * powers(0x9E3779B97F4A7C15, n), out=sums[1:])
    grams = mix((sums[k:] - sums[:-k]) * powers(INVERSE, n + 1)[:n - k + 1]) >> U(32)
    low = U((1 << 32) - 1)
    keys = (grams << U(32)) | (low - np.arange(n - k + 1, dtype=U))  # smallest hash, then rightmost place
    best = slide_min(keys, min(window, len(keys)))
    best = best[np.concatenate(([True], best[1:] != best[:-1]))]
    return (best >> U(32)).astype(np.uint32), (low - (best & low)).astype(np.int64)


def as_text(hashes: np.ndarray) -> str:
    """The fingerprint as one string: eight hex digits for each hash, in order of position."""
    return hashes.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared distinct hashes over all distinct hashes."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, and the chosen hashes and positions of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        for b in batches:
            both = [winnow(t, gram, window) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([as_text(h) for h, _ in both]),
                 pa.array([h.astype(np.int64) for h, _ in both], pa.list_(pa.int64())),
                 pa.array([p for _, p in both], pa.list_(pa.int64()))],
                names=["doc_id", "fingerprint", "hashes", "positions"])

    return src.mapInArrow(run, f"doc_id {kind}, fingerprint string, hashes array<bigint>, positions array<bigint>")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (id, text, guard, part) dealt by id ranges and sorted, the first rows of the following range at the end.

    Every task can then read its rows in order and know each one's successor. The first row of all stands at the end
    of the last range as well. The ranges are quantiles of the ids; only their bounds reach the driver.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stats = docs.agg(F.percentile_approx("id", [i / n for i in range(n)], 10_000).alias("at"),
                     F.min("id").alias("least"), F.count_if(F.col("id").isNull()).alias("nulls")).first()
    bounds = sorted(set(stats["at"] or []) - {stats["least"]})
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    edges = F.array(*[F.lit(x).cast("long") for x in bounds]) if bounds else F.array(F.lit(None).cast("long"))
    part = F.lit(0)
    if bounds:  # binary search: how many bounds are at most the id
        part = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda p, s: F.when(
            (p + s <= len(bounds)) & (F.element_at(edges, F.least(p + s, F.lit(len(bounds)))) <= F.col("id")), p + s).otherwise(p))
    first = F.col("id").isNull() if stats["nulls"] else F.col("id") == F.lit(stats["least"])
    opens = F.element_at(edges, F.greatest(F.col("part"), F.lit(1))) == F.col("id")
    copies = F.array_compact(F.array(
        F.struct(F.col("part"), F.lit(0).alias("guard")),
        F.when((F.col("part") > 0) & opens, F.struct((F.col("part") - 1).alias("part"), F.lit(1).alias("guard"))),
        F.when(first, F.struct(F.lit(len(bounds)).alias("part"), F.lit(2).alias("guard")))))
    dealt = docs.withColumn("part", part).select("id", "text", F.inline(copies).alias("part", "guard"))
    return dealt.repartition(n, "part").sortWithinPartitions("part", "guard", F.col("id").asc_nulls_first(), "text")


def edited_fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form (second half replaced by the next document's beginning), and
    the likenesses to the edited form and to the next document."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        held = None  # (id, text, hashes, part) that waits for its successor
        for b in batches:
            rows = []
            for i, text, part, guard in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if held is not None and held[3] != part:
                    held = None
                if guard and held is None:
                    continue  # a further guard of a range that is done
                hashes = winnow(text, gram, window)[0]
                if held is not None:
                    rows.append((held, text, hashes))
                held = None if guard else (i, text, hashes, part)
            out = []
            for (i, own, hashes, _), after, next_hashes in rows:
                n, half = len(own), len(own) // 2
                edited = own[:n - half] + after[:half]
                changed = winnow(edited, gram, window)[0]
                out.append((i, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_text(hashes),
                            as_text(changed), likeness(hashes, changed), likeness(hashes, next_hashes)))
            cols = list(zip(*out, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                                                       pa.float64(), pa.float64()), strict=True)], names=names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    out = with_next(src).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                    "edited_fingerprint string, near_edited double, near_next double")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
