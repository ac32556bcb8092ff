"""Small DataFrame helpers the operators of this subpackage share.

Columns whose names begin with two underscores are the operators' own; all other names are free for the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.config import materialize

# a word is a run of anything but blank, tab, line feed, vertical tab, form feed, carriage return
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_INDEX_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in the low 33 bits


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files."""
    return materialize(df)


def held_out(doc_id: Column) -> Column:
    """The fold no classifier may learn from: crc32 of the id's text, modulo 5, is 0. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def uniform(*cols: Column, seed: str) -> Column:
    """A number in [0, 1) drawn from md5 of the seed and the columns' text: the same in every run and engine."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def ranked(df: DataFrame, keys: list[Column], name: str, by: list[str] = ()) -> DataFrame:
    """Add ``name``: the row's place (from 0) in the order of ``keys``, or within equal ``by`` columns.

    ``by`` columns must lead the order. A range sort places the rows; the rank is the place inside the partition
    plus what earlier partitions hold, so no task sees more than its own range.
    """
    spark = df.sparkSession
    mid, n = "__mid", max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = cut(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn(mid, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(mid), _INDEX_BITS)
    index = F.col(mid).bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    counts = placed.groupBy(part.alias("__part")).count().collect()  # a row per partition
    before, total = {}, 0
    for r in sorted(counts, key=lambda r: r["__part"]):
        before[r["__part"]] = total
        total += r["count"]
    offset = F.lit(0).cast("long")
    if before:
        offset = F.element_at(F.map_from_arrays(F.array(*[F.lit(k).cast("long") for k in before]),
                                                F.array(*[F.lit(v).cast("long") for v in before.values()])), part)
    out = placed.withColumn(name, offset + index)
    if by:
        first = out.groupBy(*by).agg(F.min(name).alias("__first"))
        out = out.join(first, list(by)).withColumn(name, F.col(name) - F.col("__first")).drop("__first")
    return out.drop(mid)


def coordinates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Rows (doc_id, text, at), or with ``keep`` all columns and ``__at``; it is unique and orders rows by id.

    It is the id itself where ids are unique, as they are meant to be. Where some are null or repeated, it is the row's
    place in the order of id (null first) and text, so that every row still has a place of its own.
    """
    key, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    rows = docs if keep else docs.select(key.alias("doc_id"), text.alias("text"))
    key, text, at = (key, text, "__at") if keep else (F.col("doc_id"), F.col("text"), "at")
    per_id = docs.groupBy(F.col(id_col).alias("id")).count()
    if docs.schema[id_col].dataType.simpleString() in ("bigint", "int") and not per_id.where(
            F.col("id").isNull() | (F.col("count") > 1)).head(1):
        return rows.withColumn(at, key.cast("long"))
    return ranked(rows, [key.asc_nulls_first(), text], at)
