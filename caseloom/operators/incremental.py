"""Recompute only the orders that new data touches (OUT-9..11).

The stored 360 lies in folders by bucket of order id. New rows name the orders they touch; those orders' rows are built
anew from the silver and model tables, take the place of their old rows in the buckets concerned, and only those buckets
are written. The aggregates are kept in parts per bucket (``operators.mergeable``), so only the same buckets are
aggregated again. The result equals a full rebuild.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators.mart import order_support_360
from caseloom.operators.mergeable import BUCKET, order_bucket
from caseloom.operators.similarity import top_similarity


def changed_orders(*frames: DataFrame) -> DataFrame:
    """The different order ids (null is one) of new or changed rows."""
    return reduce(DataFrame.unionByName, [f.select("order_id") for f in frames]).distinct()


def changed_matches(stored: DataFrame, similarity: DataFrame) -> DataFrame:
    """The orders of stored tickets whose most similar ticket, or its score, is another now."""
    now = top_similarity(similarity).select(F.col("ticket_id").alias("_t"), F.col("matched_ticket_id").alias("_m"), F.col("similarity_score").alias("_s"))
    had = stored.filter(F.col("has_ticket")).select("order_id", "ticket_id", "most_similar_ticket_id", "most_similar_ticket_score")
    same = F.col("most_similar_ticket_id").eqNullSafe(F.col("_m")) & (F.col("most_similar_ticket_score") == F.coalesce("_s", F.lit(0.0)))
    return had.join(now, F.col("ticket_id") == F.col("_t"), "left").where(~same).select("order_id").distinct()


def changed_since(df: DataFrame, when) -> DataFrame:
    """The rows of a stored table's files written after ``when`` (a timestamp); older files are not opened."""
    return df.where(F.col("_metadata.file_modification_time") > F.lit(when))


def _of(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    named = keys.select(F.col("order_id").alias("_changed"))
    return df.join(named, F.col("order_id").eqNullSafe(F.col("_changed")), how)


def touched_buckets(changed: DataFrame, buckets: int) -> list[int]:
    """The numbers of the buckets with a changed order: at most ``buckets``."""
    return sorted(r[0] for r in changed.select(order_bucket(buckets)).distinct().collect())


def refreshed(stored: DataFrame, changed: DataFrame, touched: list[int], buckets: int, orders: DataFrame, shipments: DataFrame, returns: DataFrame,
              enrichment: DataFrame, similarity: DataFrame | None, **options) -> DataFrame:
    """The rows of all ``touched`` buckets: changed orders anew, the others as stored (read from those folders only)."""
    tickets = _of(enrichment, changed, "left_semi")
    fresh = order_support_360(_of(orders, changed, "left_semi"), _of(shipments, changed, "left_semi"), _of(returns, changed, "left_semi"),
                              tickets, similarity, **options).withColumn(BUCKET, order_bucket(buckets))
    kept = _of(stored.where(F.col(BUCKET).isin(touched)), changed, "left_anti")
    return fresh.unionByName(kept.select(*fresh.columns))
