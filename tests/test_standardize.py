import datetime as dt

from caseloom.operators import standardize
from caseloom.schemas import RAW_ORDERS, RAW_SHIPMENTS


def test_orders_casts_bad_cells_to_null(spark):
    rows = [
        ("O1", "C1", "Ann", "P1", "Mug", "kitchen", "2026-03-01T14:00:00", "Pune", "3", "2.5", "7.5", "paid"),
        ("O2", "C2", "Bo", "P2", "Cup", "Kitchen", "", "Goa", "abc", "x", "", "Paid"),
        ("O3", "C3", "Cy", "P3", "Pan", "KITCHEN", "not a date", "Goa", "2.0", "1e3", "10", None),
    ]
    out = standardize.standardize_orders(spark.createDataFrame(rows, RAW_ORDERS)).orderBy("order_id").collect()
    assert out[0].order_date == dt.datetime(2026, 3, 1, 14, 0)
    assert (out[0].quantity, out[0].unit_price, out[0].order_amount) == (3, 2.5, 7.5)
    assert out[0].payment_status == "PAID" and out[1].product_category == "KITCHEN"
    assert out[1].order_date is None and out[1].quantity is None and out[1].unit_price is None
    assert out[1].order_amount is None
    # "2.0" is not an int (SEM-1); "1e3" is a double
    assert out[2].quantity is None and out[2].unit_price == 1000.0 and out[2].order_date is None
    assert out[2].payment_status is None


def test_shipment_flags_strict_threshold_and_nulls(spark):
    rows = [
        ("S1", "O1", "X", "2026-03-01T00:00:00", "2026-03-02T00:00:00", "2026-03-03T00:00:00", "24", "delayed"),
        ("S2", "O2", "X", None, None, None, "24.5", "delivered"),
        ("S3", "O3", "X", None, None, None, "", "Delivered_Damaged"),
        ("S4", "O4", "X", None, None, None, "1", "DELIVERED"),
    ]
    out = {r.shipment_id: r for r in
           standardize.standardize_shipments(spark.createDataFrame(rows, RAW_SHIPMENTS)).collect()}
    assert out["S1"].delivery_delayed_flag is False and out["S1"].delivery_exception_flag is True
    assert out["S2"].delivery_delayed_flag is True and out["S2"].delivery_exception_flag is False
    assert out["S3"].delivery_delayed_flag is None and out["S3"].delivery_exception_flag is True
    assert out["S4"].delivery_exception_flag is False
    assert out["S1"].delivery_time == dt.datetime(2026, 3, 3)


def test_extra_columns_pass_through(spark):
    df = spark.createDataFrame([("T1", "O1", "C1", "2026-01-01T00:00:00", "email", "hi", "n", "x")],
                               "ticket_id string, order_id string, customer_id string, created_at string, "
                               "channel string, customer_message string, agent_notes string, extra string")
    r = standardize.standardize_tickets(df).collect()[0]
    assert r.channel == "EMAIL" and r.extra == "x" and r.created_at == dt.datetime(2026, 1, 1)
