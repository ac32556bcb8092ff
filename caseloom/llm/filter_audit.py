"""Filter interaction audit: what each filter removes, in every order the filters can be applied.

The sets of filters applied so far form a lattice; applying one more filter walks an edge. Counting paths forward from
the empty set and backward from the full one gives how many orders walk each edge. Documents are reduced to counts by
(part, set of filters they fail) once; each edge's removals come from those counts. An order's steps are the edges on
its path, and a filter's Shapley sum weighs its edges' removals by the number of orders that walk them.

Results for odd input: a null text is empty; a null part is the empty string; equal texts are told by sha256, and a row
fails as a copy only if a row of a smaller id has its text, so a null id neither fails nor makes others fail, and rows
that repeat id and text don't fail each other; labels given more than once count as 1 if any is 1; texts of any length
are read whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.frames import WORD_PATTERN, let, table

FILTERS = "ABCDE"


def lattice(n: int) -> list[tuple[int, int, int]]:
    """(state, bit, orders) of every edge: the filter ``bit`` is applied after the set ``state``, in so many orders."""
    full = (1 << n) - 1
    bits = [1 << i for i in range(n)]
    reach = [1] + [0] * full  # orders of the filters in a state
    for state in range(1, full + 1):
        reach[state] = sum(reach[state ^ b] for b in bits if state & b)
    leave = [0] * full + [1]  # orders of the filters not yet in it
    for state in reversed(range(full)):
        leave[state] = sum(leave[state | b] for b in bits if not state & b)
    return [(state, b, reach[state] * leave[state | b]) for state in range(full + 1) for b in bits if not state & b]


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The audit of rows (part string, failed int, good boolean, toxic boolean); bit i of ``failed`` is filters[i].

    The number of orders is the factorial of the number of filters, which is meant to be small; rows are only counted.
    """
    def number(condition: Column, n: str = "n") -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(n))), F.lit(0)).cast("long")

    counts = rows.groupBy("part", "failed").agg(
        F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("n_good"), F.sum(F.col("toxic").cast("long")).alias("n_toxic"))
    edge = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(b).alias("bit"), F.lit(w).cast("long").alias("orders")) for s, b, w in lattice(len(filters))])
    failed, bit = F.col("failed"), F.col("bit")
    fails, gone = failed.bitwiseAND(bit) != 0, failed.bitwiseAND(F.col("state")) != 0
    edges = counts.withColumn("edge", F.explode(edge)).select("*", "edge.*").groupBy("part", "state", "bit", "orders").agg(
        number(~fails & ~gone).alias("kept"), number(fails & ~gone).alias("removed"), number(fails & gone).alias("redundant"),
        number(failed == bit).alias("unique_fails"), number(fails & ~gone, "n_good").alias("good_lost"),
        number(fails & ~gone, "n_toxic").alias("toxic_lost"))
    shapley = edges.groupBy("part", "bit").agg(F.sum(F.col("orders") * F.col("removed")).alias("shapley"))
    steps = [("".join(filters[i] for i in order), k + 1, sum(1 << i for i in order[:k]), 1 << order[k])
             for order in permutations(range(len(filters))) for k in range(len(filters))]
    orders = rows.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, bit int")
    return orders.join(edges, ["state", "bit"]).join(shapley, ["part", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic) of every document, for the five filters of ``FILTERS``."""
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))
    tests = let(words, lambda w: F.struct((F.size(w) < 200).alias("a"), (100 * F.size(F.array_distinct(w)) < 50 * F.size(w)).alias("b")))
    of_text = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), tests.alias("t"),
                          (100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 3 * F.length(text)).alias("c"), text.rlike(r"[#$%&*|]").alias("d"))
    light = of_text.select("doc_id", "part", "digest", sum(F.when(F.col(c), 1 << i).otherwise(0) for i, c in enumerate(("t.a", "t.b", "c", "d"))).alias("failed"))
    firsts = light.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    copies = light.join(firsts, "digest", "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    marks = labels.groupBy(F.col("doc_id").alias("of")).agg(*[F.max((F.col(c) == 1).cast("int")).alias(c) for c in ("quality", "toxic")])
    return copies.join(marks, F.col("doc_id") == F.col("of"), "left").select(
        "part", (F.col("failed") + F.when(F.col("copy"), 16).otherwise(0)).alias("failed"),
        *[F.coalesce(F.col(c) == 1, F.lit(False)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP13_SQL = r"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
worded AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
firsts AS (SELECT t, min(doc_id) AS first FROM texts GROUP BY t),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(worded.doc_id > first, false)::INT AS mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM worded JOIN firsts USING (t) LEFT JOIN marks ON worded.doc_id = marks.doc_id),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, mask),
orders AS (
  SELECT '' AS o, 0 AS k UNION ALL
  SELECT o || f, k + 1 FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS x(f) WHERE NOT contains(o, f)),
steps AS (
  SELECT o, step, substr(o, step, 1) AS f, 1 << (ascii(substr(o, step, 1)) - 65) AS bit,
    coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(o, i, 1)) - 65))), 0)::INT AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step) WHERE k = 5),
counted AS (
  SELECT part, o, step, f,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit != 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit != 0 AND mask & before != 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit != 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit != 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, o, step, f)
SELECT part, o AS filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
