"""Raw → silver: typed casts, upper-cased codes and shipment flags (OUT-1..5).

Each function takes the raw table as read (all text) and returns it with the
listed columns replaced in place; any other column passes through unchanged.
Bad cells become null instead of failing the job (try_cast, SEM-1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.schemas import DELAY_THRESHOLD_HOURS, EXCEPTION_STATUSES


def to_ts(name: str) -> Column:
    """ISO-8601 text without zone → timestamp (wall clock, no zone); bad → null."""
    return F.col(name).try_cast("timestamp_ntz")


def to_int(name: str) -> Column:
    return F.col(name).try_cast("int")


def to_double(name: str) -> Column:
    return F.col(name).try_cast("double")


def upper(name: str) -> Column:
    return F.upper(F.col(name))


def bad_cells(raw: DataFrame, typed: DataFrame) -> Column:
    """How many filled text cells of ``raw`` cannot be read as the type they have in ``typed`` and become null (SEM-1).

    An aggregate over the raw rows, to be observed while they are written."""
    total = F.lit(0).cast("long")
    for f in typed.schema.fields:
        if f.name in raw.columns and f.dataType.simpleString() != "string":
            cell = F.col(f.name)
            total = total + F.count_if((F.trim(cell) != "") & cell.try_cast(f.dataType).isNull())
    return total


def _replace(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    # one projection, original column order kept, new columns appended
    return df.withColumns(exprs)


def standardize_orders(raw: DataFrame) -> DataFrame:
    return _replace(raw, {
        "order_date": to_ts("order_date"),
        "quantity": to_int("quantity"),
        "unit_price": to_double("unit_price"),
        "order_amount": to_double("order_amount"),
        "payment_status": upper("payment_status"),
        "product_category": upper("product_category"),
    })


def shipment_flags(delay_hours: Column, shipment_status: Column,
                   threshold: float = DELAY_THRESHOLD_HOURS) -> dict[str, Column]:
    """PRJ-5/6: delayed = delay > threshold (strict, null stays null);
    exception = status in the exception list."""
    return {
        "delivery_delayed_flag": delay_hours > F.lit(threshold),
        "delivery_exception_flag": shipment_status.isin(*EXCEPTION_STATUSES),
    }


def standardize_shipments(raw: DataFrame, threshold: float = DELAY_THRESHOLD_HOURS) -> DataFrame:
    typed = _replace(raw, {
        "dispatch_time": to_ts("dispatch_time"),
        "expected_delivery_time": to_ts("expected_delivery_time"),
        "delivery_time": to_ts("delivery_time"),
        "delay_hours": to_double("delay_hours"),
        "shipment_status": upper("shipment_status"),
    })
    return typed.withColumns(shipment_flags(F.col("delay_hours"), F.col("shipment_status"), threshold))


def standardize_returns(raw: DataFrame) -> DataFrame:
    return _replace(raw, {
        "requested_at": to_ts("requested_at"),
        "refund_amount": to_double("refund_amount"),
        "reason_code": upper("reason_code"),
        "return_status": upper("return_status"),
    })


def standardize_products(raw: DataFrame) -> DataFrame:
    return _replace(raw, {
        "catalog_price": to_double("catalog_price"),
        "category": upper("category"),
    })


def standardize_tickets(raw: DataFrame) -> DataFrame:
    return _replace(raw, {
        "created_at": to_ts("created_at"),
        "channel": upper("channel"),
    })


STANDARDIZERS = {
    "orders": standardize_orders,
    "shipments": standardize_shipments,
    "returns": standardize_returns,
    "products": standardize_products,
    "support_tickets": standardize_tickets,
}
