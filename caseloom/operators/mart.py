"""The order_support_360 gold table (OUT-9: WIN-1, JN-1..4, PRJ-7..10).

Join plan: enrichment ⟕ top-1 similarity first (ticket-sized, so orders without
a ticket never carry a null ticket key into a shuffle, OPT-8); then one chain of
left joins that are all keyed by order_id, so each input is shuffled once and
the joins after the first reuse that partitioning. Orders whose key is null can
match nothing; they skip the joins and are appended with empty right sides, so
they never pile up in the single partition that null keys hash to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators.similarity import top_similarity
from caseloom.operators.skew import Side, left_join_chain
from caseloom.schemas import DELAY_THRESHOLD_HOURS, MART_COLUMNS

_SHIPMENT_COLS = ["shipment_id", "carrier", "dispatch_time", "expected_delivery_time", "delivery_time",
                  "delay_hours", "shipment_status"]
_RETURN_COLS = ["return_id", "reason_code", "refund_amount", "return_status"]
_TICKET_COLS = ["ticket_id", "issue_category", "sentiment", "urgency", "requires_human_followup",
                "root_cause_hint", "customer_summary", "next_best_action"]
_ORDER_COLS = MART_COLUMNS[:12]


def ticket_side(enrichment: DataFrame, similarity: DataFrame | None) -> DataFrame:
    """Enrichment with its best match attached (JN-4), keyed for the order join."""
    te = enrichment.select(
        F.col("order_id").alias("_te_order_id"), F.col("customer_id").alias("_te_customer_id"), *_TICKET_COLS)
    if similarity is None:
        return te.withColumns({"most_similar_ticket_id": F.lit(None).cast("string"),
                               "most_similar_ticket_score": F.lit(None).cast("double")})
    top = top_similarity(similarity).select(
        "ticket_id",
        F.col("matched_ticket_id").alias("most_similar_ticket_id"),
        F.col("similarity_score").alias("most_similar_ticket_score"))
    return te.join(top, "ticket_id", "left").select(
        "_te_order_id", "_te_customer_id", *_TICKET_COLS, "most_similar_ticket_id", "most_similar_ticket_score")


def _flags(df: DataFrame, threshold: float) -> DataFrame:
    return (
        df.withColumns({
            "has_ticket": F.col("ticket_id").isNotNull(),
            "has_return": F.col("return_id").isNotNull(),
            "delay_hours": F.coalesce(F.col("delay_hours"), F.lit(0.0)),
            "refund_amount": F.coalesce(F.col("refund_amount"), F.lit(0.0)),
            "most_similar_ticket_score": F.coalesce(F.col("most_similar_ticket_score"), F.lit(0.0)),
        })
        # computed after the 0.0 fill, so it is never null (PRJ-10, SEM-3)
        .withColumn("risk_flag", F.col("has_ticket") | F.col("has_return")
                    | (F.col("delay_hours") > F.lit(threshold)))
        .select(*MART_COLUMNS)
    )


def order_support_360(orders: DataFrame, shipments: DataFrame, returns: DataFrame,
                      enrichment: DataFrame, similarity: DataFrame | None = None,
                      threshold: float = DELAY_THRESHOLD_HOURS,
                      hot_key_rows: int | None = 1_000_000,
                      key_sources: list[DataFrame | None] | None = None) -> DataFrame:
    """One row per order and matching shipment × return × ticket (SEM-9 fan-out kept).

    A ticket joins only when both order_id and customer_id agree (JN-3, SEM-10).
    An order_id with more than ``hot_key_rows`` shipments, returns or tickets
    is joined spread over many tasks (``operators.skew``); ``None`` skips the check.
    ``lost_tickets`` counts the tickets that find no order.
    ``key_sources``: for shipments, returns and tickets, a cheaper frame with an
    ``order_id`` column whose rows per key are at least the side's (for example
    the source rows a derived side is built from). Rows per key are counted
    there; a miss only costs balance, never rows.
    """
    o = orders.select(*_ORDER_COLS)
    s = shipments.select("order_id", *_SHIPMENT_COLS)
    r = returns.select("order_id", *_RETURN_COLS)
    te = ticket_side(enrichment, similarity)

    src = key_sources or [None, None, enrichment.select("order_id")]
    keyed = o.filter(F.col("order_id").isNotNull())
    joined = left_join_chain(
        keyed, "order_id",
        [Side(s, "order_id", count_on=src[0]),
         Side(r, "order_id", count_on=src[1]),
         Side(te, "_te_order_id", [("customer_id", "_te_customer_id")], count_on=src[2], count_key="order_id")],
        hot_threshold=hot_key_rows,
    )
    unkeyed = o.filter(F.col("order_id").isNull())
    empty_right = {c: F.lit(None).cast(joined.schema[c].dataType)
                   for c in joined.columns if c not in _ORDER_COLS}
    unkeyed = unkeyed.withColumns(empty_right).select(*joined.columns)
    return _flags(joined.unionByName(unkeyed), threshold)


def lost_tickets(orders: DataFrame, enrichment: DataFrame) -> DataFrame:
    """One row: tickets in all, and those the mart cannot show because no order has their order and customer (SEM-10)."""
    known = orders.select(F.col("order_id").alias("_o"), F.col("customer_id").alias("_c")).distinct()
    match = (F.col("order_id") == F.col("_o")) & (F.col("customer_id") == F.col("_c"))
    return enrichment.select("order_id", "customer_id").join(known, match, "left").agg(
        F.count(F.lit(1)).alias("tickets"), F.count_if(F.col("_o").isNull()).alias("lost"))


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """The frame itself, or an error if a key occurs twice (SEM-9: opt-in check against fan-out)."""
    twice = df.groupBy(key).count().where(F.col("count") > 1).head(1)
    if twice:
        raise ValueError(f"{key} {twice[0][0]!r} occurs {twice[0][1]} times")
    return df
