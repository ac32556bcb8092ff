import datetime as dt


from caseloom.operators import brief, kpis, mart, reports
from caseloom.schemas import MART_COLUMNS

TS = dt.datetime(2026, 3, 1)
ORDERS = "order_id string, customer_id string, customer_name string, product_id string, product_name string, " \
         "product_category string, order_date timestamp_ntz, city string, quantity int, unit_price double, " \
         "order_amount double, payment_status string"
SHIP = "shipment_id string, order_id string, carrier string, dispatch_time timestamp_ntz, " \
       "expected_delivery_time timestamp_ntz, delivery_time timestamp_ntz, delay_hours double, shipment_status string"
RET = "return_id string, order_id string, reason_code string, refund_amount double, return_status string"
ENR = "ticket_id string, order_id string, customer_id string, created_at timestamp_ntz, channel string, " \
      "issue_category string, sentiment string, urgency string, requires_human_followup boolean, " \
      "root_cause_hint string, pii_redacted_message string, customer_summary string, next_best_action string, " \
      "agent_notes string"
SIM = "ticket_id string, matched_ticket_id string, similarity_rank int, similarity_score double"


def _order(oid, cust, city="Pune", amount=100.0):
    return (oid, cust, "n", "P", "prod", "CAT", TS, city, 1, amount, amount, "PAID")


def _ticket(tid, oid, cust, cat="DELIVERY_DELAY", urgency="HIGH"):
    return (tid, oid, cust, TS, "EMAIL", cat, "NEGATIVE", urgency, True, "h", "m", "s", "a", "n")


def build(spark):
    orders = spark.createDataFrame([
        _order("O1", "C1"),                    # nothing else
        _order("O2", "C2"),                    # only a return
        _order("O3", "C3"),                    # only a 25 h delay
        _order("O4", "C4"),                    # ticket of another customer -> dropped
        _order("O5", "C5", amount=50.0),       # two returns -> fan-out
        _order("O6", "C6", city="Goa"),        # two tickets
        _order("O7", "C7", city="Goa"),        # ticket without similarity row
        _order(None, "C8"),                    # null key: kept, matches nothing
    ], ORDERS)
    ships = spark.createDataFrame([
        ("S3", "O3", "X", TS, TS, TS, 25.0, "DELAYED"),
        ("S6", "O6", "X", TS, TS, TS, 24.0, "DELIVERED"),
    ], SHIP)
    rets = spark.createDataFrame([
        ("R2", "O2", "WRONG_ITEM", 10.0, "OPEN"),
        ("R5a", "O5", "WRONG_ITEM", 20.0, "OPEN"),
        ("R5b", "O5", "DEFECTIVE_ITEM", 30.0, "OPEN"),
        ("R9", None, "X", 1.0, "OPEN"),
    ], RET)
    enr = spark.createDataFrame([
        _ticket("T4", "O4", "C99"),
        _ticket("T5", "O5", "C5", cat="DAMAGED_ITEM", urgency=None),
        _ticket("T6a", "O6", "C6", urgency="MEDIUM"),
        _ticket("T6b", "O6", "C6", cat="REFUND_DELAY", urgency="LOW"),
        _ticket("T7", "O7", "C7"),
        _ticket("T8", "O404", "C1"),           # unknown order -> vanishes
    ], ENR)
    sim = spark.createDataFrame([
        ("T5", "T6a", 1, 0.9), ("T5", "T7", 2, 0.8), ("T6a", "T5", 1, 0.9), ("T6b", "T5", 1, 0.7),
    ], SIM)
    return mart.order_support_360(orders, ships, rets, enr, sim)


def test_mart_rows_and_flags(spark):
    m = build(spark)
    assert m.columns == MART_COLUMNS
    rows = m.collect()
    by = {}
    for r in rows:
        by.setdefault(r.order_id, []).append(r)
    assert len(rows) == 10  # 8 orders, O5 x2 returns, O6 x2 tickets
    assert by["O1"][0].risk_flag is False and by["O1"][0].delay_hours == 0.0 and by["O1"][0].refund_amount == 0.0
    assert by["O2"][0].has_return and by["O2"][0].risk_flag
    assert by["O3"][0].risk_flag and not by["O3"][0].has_ticket
    assert by["O4"][0].ticket_id is None and by["O4"][0].risk_flag is False
    assert sorted(r.return_id for r in by["O5"]) == ["R5a", "R5b"]
    assert {r.most_similar_ticket_id for r in by["O5"]} == {"T6a"}
    assert sorted(r.ticket_id for r in by["O6"]) == ["T6a", "T6b"]
    assert by["O6"][0].delay_hours == 24.0
    assert by["O7"][0].most_similar_ticket_id is None and by["O7"][0].most_similar_ticket_score == 0.0
    assert by[None][0].customer_id == "C8" and by[None][0].risk_flag is False


def test_kpis_count_fanout_rows_but_distinct_orders(spark):
    m = build(spark)
    k = {r.issue_category: r for r in kpis.issue_kpis(m).collect()}
    assert k["DAMAGED_ITEM"].ticket_count == 2 and k["DAMAGED_ITEM"].impacted_orders == 1
    assert k["DAMAGED_ITEM"].average_refund_amount == 25.0
    assert k["DELIVERY_DELAY"].ticket_count == 2 and k["REFUND_DELAY"].ticket_count == 1
    h = {(r.city, r.issue_category): r.ticket_count for r in kpis.city_issue_hotspots(m).collect()}
    assert h[("Goa", "DELIVERY_DELAY")] == 2 and h[("Pune", "DAMAGED_ITEM")] == 2
    assert sum(h.values()) == m.filter("has_ticket").count()


def test_high_risk_order(spark):
    m = build(spark)
    out = reports.high_risk_orders(m).collect()
    urg = [r.urgency for r in out]
    assert urg.index("HIGH") < urg.index("MEDIUM") < urg.index("LOW")
    assert urg[-1] in (None, "LOW") and None in urg


def test_sql_reports_equal_dataframe_reports(spark):
    m = build(spark)
    m.createOrReplaceTempView("order_support_360")
    kpis.issue_kpis(m).createOrReplaceTempView("issue_kpis")
    kpis.city_issue_hotspots(m).createOrReplaceTempView("city_issue_hotspots")
    pairs = [
        ("issue_volume_by_category", reports.issue_volume_by_category(m)),
        ("city_hotspots_top25", reports.city_hotspots(m)),
        ("high_risk_orders", reports.high_risk_orders(m)),
        ("brief_kpi_top10", reports.brief_kpi_top(spark.table("issue_kpis"))),
        ("brief_hotspot_top10", reports.brief_hotspot_top(spark.table("city_issue_hotspots"))),
    ]
    for name, df in pairs:
        assert reports.run_report_sql(spark, name).collect() == df.collect(), name


def _kpi_rows(spark, n, null_city=False):
    k = spark.createDataFrame(
        [(f"CAT{i:02d}", 100 - i, 90 - i, float(i), 10.0, 0.0) for i in range(n)],
        "issue_category string, ticket_count long, impacted_orders long, average_delay_hours double, "
        "average_order_amount double, average_refund_amount double")
    h = spark.createDataFrame(
        [(None if null_city and i == 0 else f"City{i}", f"CAT{i:02d}", 50 - i, 1.5) for i in range(n)],
        "city string, issue_category string, ticket_count long, average_delay_hours double")
    return reports.brief_kpi_top(k), reports.brief_hotspot_top(h)


def test_metric_block_limits_and_nulls(spark):
    kt, ht = _kpi_rows(spark, 12, null_city=True)
    block = brief.metrics_block(kt, ht).collect()[0].metrics_block
    lines = block.split("\n")
    assert lines[0] == "Top issue KPI rows:" and lines[11] == "" and lines[12] == "Top city hotspot rows:"
    assert lines[1] == "- CAT00: tickets=100, impacted_orders=90, avg_delay_hours=0.0, avg_refund_amount=0.0"
    assert len(lines) == 23 and lines[14] == "- City1 / CAT01: tickets=49, avg_delay_hours=1.5"
    assert lines[13] == "-  / CAT00: tickets=50, avg_delay_hours=1.5"  # null city renders empty (SEM-25)
    text = brief.daily_brief(kt, ht).collect()[0].brief
    assert text.startswith("# Daily operations brief: CAT00 is the highest-risk issue category")
    assert text.endswith(block)


def test_brief_without_rows(spark):
    kt, ht = _kpi_rows(spark, 0)
    block = brief.metrics_block(kt, ht).collect()[0].metrics_block
    assert block == "Top issue KPI rows:\n\nTop city hotspot rows:"
    assert "no support tickets" in brief.daily_brief(kt, ht).collect()[0].brief


def test_hot_order_key_is_spread_and_exact(spark):
    """One order holds most shipments, returns and tickets: the salted path
    gives exactly the rows of the plain chain."""
    orders = spark.createDataFrame([_order(f"O{i}", f"C{i}") for i in range(6)] + [_order(None, "CX")], ORDERS)
    ships = spark.createDataFrame(
        [(f"S{i}", "O1", "X", TS, TS, TS, float(i), "DELAYED") for i in range(40)]
        + [("S99", "O2", "X", TS, TS, TS, 30.0, "DELAYED")]
        + [("S5", "O5", "X", TS, TS, TS, 1.0, "DELIVERED")] * 9, SHIP)  # a hot group of identical copies
    rets = spark.createDataFrame([(f"R{i}", "O1", "WRONG_ITEM", float(i), "OPEN") for i in range(5)]
                                 + [(f"Q{i}", "O3", "WRONG_ITEM", 1.0, "OPEN") for i in range(12)], RET)
    enr = spark.createDataFrame([_ticket("T1", "O1", "C1"), _ticket("T1b", "O1", "C9"), _ticket("T3", "O3", "C3"),
                                 _ticket("T4", "O4", "C4")], ENR)
    plain = mart.order_support_360(orders, ships, rets, enr, None, hot_key_rows=None)
    salted = mart.order_support_360(orders, ships, rets, enr, None, hot_key_rows=4)
    key = lambda r: tuple(str(x) for x in r)
    a = sorted(plain.collect(), key=key)
    b = sorted(salted.collect(), key=key)
    assert len(a) == 40 * 5 + 12 + 9 + 4 and a == b
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "_la" in plan  # the grid's salts


def test_brief_with_a_model_function(spark):
    import pandas as pd

    def fake_model(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: "MODEL BRIEF\n" + p.split("Metrics:\n", 1)[1].split("\n", 1)[0])

    kt, ht = _kpi_rows(spark, 3)
    text = brief.daily_brief(kt, ht, brief_fn=fake_model).collect()[0].brief
    assert text == "MODEL BRIEF\nTop issue KPI rows:"
    prompt = brief.brief_prompt_text(kt, ht).collect()[0].prompt
    assert prompt.startswith("Write a daily operations brief using the curated metrics below.")
    assert prompt.endswith("- City2 / CAT02: tickets=48, avg_delay_hours=1.5")
