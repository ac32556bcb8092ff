"""Table schemas and the fixed vocabularies of the pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's contract).
# Allowed model-reply values and the reply's required keys, in the order the
# contract lists them; shipment statuses that count as a delivery exception;
# the delay threshold in hours (strict ">").
# ---------------------------------------------------------------------------
ISSUE_CATEGORIES = [
    "DELIVERY_DELAY",
    "DAMAGED_ITEM",
    "WRONG_ITEM_SENT",
    "DELIVERY_EXCEPTION",
    "REFUND_DELAY",
    "PAYMENT_ISSUE",
    "RETURN_PICKUP_DELAY",
    "REPLACEMENT_REQUEST",
    "GENERAL_QUERY",
]
SENTIMENTS = ["POSITIVE", "NEUTRAL", "NEGATIVE"]
URGENCIES = ["LOW", "MEDIUM", "HIGH"]
REPLY_KEYS = [
    "issue_category",
    "sentiment",
    "urgency",
    "requires_human_followup",
    "root_cause_hint",
    "pii_redacted_message",
    "customer_summary",
    "next_best_action",
]
EXCEPTION_STATUSES = ["DELAYED", "DELIVERED_DAMAGED"]
DELAY_THRESHOLD_HOURS = 24.0


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Raw layer: every CSV cell is read as text; typed casts happen in standardize.
RAW_ORDERS = _strings("order_id", "customer_id", "customer_name", "product_id", "product_name",
                      "product_category", "order_date", "city", "quantity", "unit_price",
                      "order_amount", "payment_status")
RAW_SHIPMENTS = _strings("shipment_id", "order_id", "carrier", "dispatch_time",
                         "expected_delivery_time", "delivery_time", "delay_hours", "shipment_status")
RAW_RETURNS = _strings("return_id", "order_id", "reason_code", "refund_amount", "return_status",
                       "requested_at")
RAW_PRODUCTS = _strings("product_id", "product_name", "category", "catalog_price")
RAW_TICKETS = _strings("ticket_id", "order_id", "customer_id", "created_at", "channel",
                       "customer_message", "agent_notes")

RAW_SCHEMAS = {
    "orders": RAW_ORDERS,
    "shipments": RAW_SHIPMENTS,
    "returns": RAW_RETURNS,
    "products": RAW_PRODUCTS,
    "support_tickets": RAW_TICKETS,
}

ENRICHMENT_COLUMNS = [
    "ticket_id", "order_id", "customer_id", "created_at", "channel",
    "issue_category", "sentiment", "urgency", "requires_human_followup",
    "root_cause_hint", "pii_redacted_message", "customer_summary", "next_best_action",
    "agent_notes",
]

# Column order of the 360 table: 33 selected columns, then the three flags.
MART_COLUMNS = [
    "order_id", "customer_id", "customer_name", "product_id", "product_name", "product_category",
    "order_date", "city", "quantity", "unit_price", "order_amount", "payment_status",
    "shipment_id", "carrier", "dispatch_time", "expected_delivery_time", "delivery_time",
    "delay_hours", "shipment_status",
    "return_id", "reason_code", "refund_amount", "return_status",
    "ticket_id", "issue_category", "sentiment", "urgency", "requires_human_followup",
    "root_cause_hint", "customer_summary", "next_best_action",
    "most_similar_ticket_id", "most_similar_ticket_score",
    "has_ticket", "has_return", "risk_flag",
]
