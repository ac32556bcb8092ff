"""Gold aggregates that are kept in parts and merged (AGG-1..4, and AGG-2's distinct orders exactly).

Two kinds of parts:

* per bucket of orders (``bucket_parts``): an order lies in one bucket only, so distinct orders, counts and sums of the
  buckets add up. A bucket whose orders changed is aggregated anew, the others are kept.
* per day (``daily_parts``): an order may count on several days, so each part stores the set of its orders as bitmaps
  over order numbers; merging days is a bitwise or, and the merged set is counted exactly.

Sums are decimals, so parts merge to the same digits in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.config import materialize

MEANS = ["delay_hours", "order_amount", "refund_amount"]
BUCKET = "order_bucket"


def order_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int")


def _sums() -> list[Column]:
    out = [F.count("ticket_id").alias("ticket_count")]
    for c in MEANS:
        out += [F.sum(F.col(c).cast("decimal(38,9)")).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n")]
    return out


def _added() -> list[Column]:
    return [F.sum(c).alias(c) for c in ["ticket_count", *[f"{m}_{p}" for m in MEANS for p in ("sum", "n")]]]


def _mean(name: str) -> Column:
    mean = F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_sum").cast("double") / F.col(f"{name}_n"))
    return F.coalesce(F.round(mean, 2), F.lit(0.0)).alias(f"average_{name}")


def bucket_parts(mart: DataFrame) -> DataFrame:
    """Parts per bucket, city and category of a 360 with its ``order_bucket``."""
    return mart.filter(F.col("has_ticket")).groupBy(BUCKET, "city", "issue_category").agg(*_sums())


def category_orders(mart: DataFrame) -> DataFrame:
    """Distinct orders per bucket and category: an order's rows of one category may lie in several cities."""
    return mart.filter(F.col("has_ticket")).groupBy(BUCKET, "issue_category").agg(F.count_distinct("order_id").alias("orders"))


def issue_kpis(parts: DataFrame, orders: DataFrame) -> DataFrame:
    """``kpis.issue_kpis`` from the parts of all buckets."""
    sums = parts.groupBy("issue_category").agg(*_added())
    impacted = orders.groupBy(F.col("issue_category").alias("_c")).agg(F.sum("orders").alias("impacted_orders"))
    return sums.join(impacted, F.col("issue_category").eqNullSafe(F.col("_c"))).select(
        "issue_category", "ticket_count", "impacted_orders", *[_mean(m) for m in MEANS])


def city_issue_hotspots(parts: DataFrame) -> DataFrame:
    """``kpis.city_issue_hotspots`` from the parts of all buckets."""
    return parts.groupBy("city", "issue_category").agg(*_added()).select("city", "issue_category", "ticket_count", _mean("delay_hours"))


def order_numbers(ids: DataFrame, known: DataFrame | None = None, by: Column | None = None) -> DataFrame:
    """order_id, number: a number for every different id. ``known`` keeps its numbers, new ids go on after them.

    ``by``: numbers follow this column (an order's least value of it), so that orders of one day lie in few ranges of
    numbers; a bitmap has the size of its range however few of its orders it holds. Store the result: the numbers follow
    how the ids happened to be dealt.
    """
    rows = ids.where(F.col("order_id").isNotNull())
    fresh = rows.select("order_id").distinct() if by is None else rows.groupBy("order_id").agg(F.min(by).alias("_by"))
    base = 0
    if known is not None:
        fresh = fresh.join(known.select("order_id"), "order_id", "left_anti")
        base = (known.agg(F.max("number")).first()[0] or -1) + 1
    if by is not None:
        fresh = fresh.sort("_by")
    numbered = materialize(fresh.select("order_id", (F.monotonically_increasing_id() + base).alias("number")))
    return numbered if known is None else known.select("order_id", "number").unionByName(numbered)


def daily_parts(mart: DataFrame, numbers: DataFrame, day: Column | None = None) -> DataFrame:
    """Parts per day, category and range of order numbers, each with the bitmap of its orders; to be stored by day."""
    day = day if day is not None else F.to_date("order_date")
    rows = mart.filter(F.col("has_ticket")).select(day.alias("day"), "issue_category", "order_id", "ticket_id", *MEANS).join(numbers, "order_id", "left")
    return rows.groupBy("day", "issue_category", F.bitmap_bucket_number("number").alias("number_range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("orders"), *_sums())


def merged(parts: DataFrame, *by: Column) -> DataFrame:
    """The parts of any days as one: per ``by`` (over day and issue_category) the counts, distinct orders and means."""
    keys = [f"_k{i}" for i in range(len(by))]
    keyed = parts.select(*[c.alias(k) for c, k in zip(by, keys)], *[c for c in parts.columns])
    sets = keyed.groupBy(*keys, "number_range").agg(F.bitmap_or_agg("orders").alias("orders"), *_added())
    out = sets.groupBy(*keys).agg(F.sum(F.bitmap_count("orders")).alias("impacted_orders"), *_added())
    return out.select(*keys, "ticket_count", "impacted_orders", *[_mean(m) for m in MEANS])
