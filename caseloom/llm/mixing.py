"""Mixing sources to target weights: tokens per source, repetition rates, and copies of each document.

Targets share the total by weight; a target stops at ``most`` times its source's tokens, and the excess goes to the
others by weight until none is above. A document is emitted floor(rate) times, and once more if its hash-seeded draw
falls below the rest of the rate, so reruns agree and no document exceeds ``most`` copies.

Results for odd input: a null text has no tokens; a null source is a source of its own, last in order; a source
without tokens has target 0; repeated rows draw alike; an empty table gives no rows; extra columns are ignored by
``mix`` and kept by ``repeat``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.frames import WORD_PATTERN, cut, ranked, table, uniform

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target, rate from rows of (source, size). Weights repeat over sources by code point."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = ranked(totals, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    placed = placed.withColumn("weight", weight)
    level, cap = None, F.col("source_size") * most
    while True:  # reshare the excess until no target is above its cap
        over = F.lit(False) if level is None else cap < F.col("weight") * level
        s = placed.agg(F.sum("source_size").alias("total"), F.sum(F.when(over, cap)).alias("capped"),
                       F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        rest = s["weight"] or 0.0
        fresh = ((s["total"] or 0) - (s["capped"] or 0)) / rest if rest else (level or 0.0)
        if level is not None and fresh <= level:
            break
        level = fresh
    target = F.when(cap < F.col("weight") * level, cap.cast("double")).otherwise(F.col("weight") * level)
    return placed.select("source", "source_size", target.alias("target"),
                         F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def with_copies(rows: DataFrame, sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, seed: str = SEED,
                id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``rows`` with __source_size, __target and __copies (0 to ``most``); ``sizes`` has (source, size) of every row."""
    per_source = cut(source_targets(sizes, weights, most).select(
        F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
        F.col("rate").alias("__rate")))
    # a hot source only makes one side of the join uneven: the other has a row per source
    joined = rows.join(per_source, F.col(source_col).eqNullSafe(F.col("__source")))
    whole = F.floor("__rate")
    copies = (whole + (uniform(F.col(id_col), seed=seed) < F.col("__rate") - whole).cast("int")).cast("int")
    return joined.withColumn("__copies", F.least(copies, F.lit(most))).drop("__source", "__rate")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, seed: str = SEED, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target and copies (0 to ``most``) of every row."""
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")))
    return with_copies(rows, rows, weights, most, seed).select(
        "doc_id", "source", "size", *[F.col(f"__{c}").alias(c) for c in ("source_size", "target", "copies")])


def repeat(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, seed: str = SEED, id_col: str = "doc_id",
           text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows themselves with all their columns, each as often as the mix takes it."""
    sizes = docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    taken = with_copies(docs, sizes, weights, most, seed, id_col, source_col).where("__copies > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                        "source", "copies")


OP2_SQL = r"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::DOUBLE AS source_size FROM sizes GROUP BY source),
weighted AS (
  SELECT source, source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM totals),
levels AS (
  SELECT 0 AS round, sum(source_size) / sum(weight) AS level, -1.0::DOUBLE AS before FROM weighted
  UNION ALL
  SELECT round + 1, fresh, level FROM (
    SELECT round, level, ((SELECT sum(source_size) FROM weighted)
        - coalesce((SELECT sum(3 * source_size) FROM weighted w WHERE 3 * source_size < w.weight * level), 0))
      / (SELECT sum(w.weight) FROM weighted w WHERE NOT 3 * source_size < w.weight * level) AS fresh
    FROM levels WHERE level > before) WHERE fresh > level),
top AS (SELECT max(level) AS level FROM levels),
targets AS (
  SELECT source, source_size, CASE WHEN 3 * source_size < weight * level THEN 3 * source_size ELSE weight * level END AS target
  FROM weighted, top),
rated AS (
  SELECT doc_id, s.source, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS draw
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copied AS (SELECT *, least(floor(rate)::INT + (draw < rate - floor(rate))::INT, 3)::INT AS copies FROM rated)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, size * copies AS taken, source, copies FROM copied
"""
