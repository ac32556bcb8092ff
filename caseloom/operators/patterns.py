"""What the brief can say beyond the largest numbers (UDF-3): patterns that stand out from what is expected.

Three kinds, each with a score in standard deviations, from one small table of counts per city, category and week:

* ``hotspot``: a city has more tickets of a category than its share of all tickets and the category's share let expect;
* ``delay``: a category's mean delay lies above that of all tickets, by the standard error of its mean;
* ``trend``: a category has more tickets in the last week than in the mean of the ``BEFORE`` weeks before.

Findings need ``LEAST_TICKETS`` tickets and a score of ``LEAST_SCORE``. The 360 is read once; everything after works on
the counts, whose size follows the cities, categories and weeks, not the tickets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.config import materialize

LEAST_TICKETS, LEAST_SCORE, BEFORE = 5, 2.0, 8
COLUMNS = ["pattern", "city", "issue_category", "tickets", "observed", "expected", "score"]


def cells(mart: DataFrame) -> DataFrame:
    """Tickets and sums of their delays (and its square) per city, category and week of the order."""
    delay = F.col("delay_hours").cast("decimal(18,6)")
    week = F.to_date(F.date_trunc("week", F.col("order_date"))).alias("week")
    return mart.filter(F.col("has_ticket")).groupBy("city", "issue_category", week).agg(
        F.count(F.lit(1)).alias("n"), F.sum(delay).alias("delay"), F.sum((delay * delay).cast("decimal(38,6)")).alias("square"))


def _finding(df: DataFrame, pattern: str, observed: Column, expected: Column, deviation: Column, city: Column | None = None) -> DataFrame:
    score = F.when(deviation > 0, (observed - expected) / deviation)
    found = df.select(F.lit(pattern).alias("pattern"), (city if city is not None else F.lit(None).cast("string")).alias("city"), "issue_category",
                      F.col("n").cast("long").alias("tickets"), F.round(observed, 4).alias("observed"), F.round(expected, 4).alias("expected"),
                      F.round(score, 4).alias("score"))
    return found.where((F.col("tickets") >= LEAST_TICKETS) & (F.col("score") >= LEAST_SCORE))


def issue_patterns(mart: DataFrame) -> DataFrame:
    """The findings, unordered: pattern, city, issue_category, tickets, observed, expected, score."""
    table = materialize(cells(mart))
    whole = table.agg(F.sum("n").alias("n"), F.sum("delay").cast("double").alias("delay"), F.sum("square").cast("double").alias("square"),
                      F.max("week").alias("week")).first()
    n = float(whole["n"] or 0)
    if not n:
        return table.sparkSession.createDataFrame([], "pattern string, city string, issue_category string, tickets bigint, observed double, "
                                                      "expected double, score double")

    def total(*by: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*by)).cast("double")

    own = table.groupBy("city", "issue_category").agg(F.sum("n").alias("n"))
    chance = own.withColumns({"of_city": total("city"), "of_category": total("issue_category")}).withColumn(
        "expected", F.col("of_city") * F.col("of_category") / n)
    hotspots = _finding(chance, "hotspot", F.col("n").cast("double"), F.col("expected"), F.sqrt("expected"), F.col("city"))

    mean = whole["delay"] / n
    spread = max(whole["square"] / n - mean * mean, 0.0)
    per_category = table.groupBy("issue_category").agg(F.sum("n").alias("n"), F.sum("delay").cast("double").alias("delay"))
    delays = _finding(per_category, "delay", F.col("delay") / F.col("n"), F.lit(mean), F.sqrt(F.lit(spread) / F.col("n")))

    if whole["week"] is None:
        return hotspots.unionByName(delays)
    last = F.lit(whole["week"])
    earlier = (F.col("week") < last) & (F.col("week") >= F.date_sub(last, 7 * BEFORE))
    weeks = table.groupBy("issue_category").agg(
        F.sum(F.when(F.col("week") == last, F.col("n")).otherwise(0)).alias("n"),
        (F.sum(F.when(earlier, F.col("n")).otherwise(0)).cast("double") / BEFORE).alias("expected"))
    trends = _finding(weeks, "trend", F.col("n").cast("double"), F.col("expected"), F.sqrt("expected"))
    return reduce(DataFrame.unionByName, [hotspots, delays, trends])


def sentence() -> Column:
    """A finding in words."""
    named, city = F.coalesce(F.col("issue_category"), F.lit("")), F.coalesce(F.col("city"), F.lit(""))
    number = [F.format_string("%.1f", F.col(c)) for c in ("observed", "expected")]
    return F.when(F.col("pattern") == "hotspot", F.concat(city, F.lit(" has "), F.col("tickets").cast("string"), F.lit(" "), named, F.lit(" tickets where "), number[1],
                                                          F.lit(" are expected."))) \
        .when(F.col("pattern") == "delay", F.concat(named, F.lit(" waits "), number[0], F.lit(" hours on average against "), number[1], F.lit(" in all."))) \
        .otherwise(F.concat(named, F.lit(" has "), F.col("tickets").cast("string"), F.lit(" tickets in the last week against "), number[1], F.lit(" a week before.")))


def pattern_lines(patterns: DataFrame, limit: int = 5) -> DataFrame:
    """rank, line: the ``limit`` findings of the greatest scores in words."""
    top = patterns.orderBy(F.col("score").desc(), "pattern", F.col("issue_category").asc_nulls_last(), F.col("city").asc_nulls_last()).limit(limit)
    place = Window.orderBy(F.col("score").desc(), "pattern", F.col("issue_category").asc_nulls_last(), F.col("city").asc_nulls_last())
    return top.select(F.row_number().over(place).alias("rank"), sentence().alias("line"))  # over at most ``limit`` rows
