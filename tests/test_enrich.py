import json

import pandas as pd
import pytest
from pyspark.sql import types as T

from caseloom.functions.text import embedding_text, ticket_prompt
from caseloom.operators.enrich import enrich
from caseloom.schemas import ENRICHMENT_COLUMNS, RAW_TICKETS

TICKETS = [
    ("T1", "O1", "C1", "2026-03-01T10:00:00", "EMAIL", "My parcel is late, still waiting. Call 9800000044", "n1"),
    ("T2", "O2", "C2", "2026-03-01T11:00:00", "CHAT", "The mug arrived broken!! Unacceptable.", "n2"),
    ("T3", "O3", "C3", "2026-03-01T12:00:00", "WEB", "Please book the pickup for my return", None),
    ("T4", "O4", "C4", "2026-03-01T13:00:00", "PHONE", "What are your opening hours? Thanks", "n4"),
    ("T5", "O5", "C5", "2026-03-01T14:00:00", "PHONE", "I was charged twice, fix it urgently", "n5"),
]


def _tickets(spark):
    return spark.createDataFrame(TICKETS, RAW_TICKETS)


def test_rule_enrichment(spark):
    out = {r.ticket_id: r for r in enrich(_tickets(spark)).collect()}
    assert out["T1"].issue_category == "DELIVERY_DELAY"
    assert out["T1"].pii_redacted_message.endswith("[REDACTED_PHONE]")
    assert out["T2"].issue_category == "DAMAGED_ITEM" and out["T2"].sentiment == "NEGATIVE"
    assert out["T2"].requires_human_followup is True
    assert out["T3"].issue_category == "RETURN_PICKUP_DELAY"
    assert out["T4"].issue_category == "GENERAL_QUERY" and out["T4"].urgency == "LOW"
    assert out["T4"].sentiment == "POSITIVE"
    assert out["T5"].issue_category == "PAYMENT_ISSUE" and out["T5"].urgency == "HIGH"
    assert all(r.enum_ok and r.reply_error is None for r in out.values())
    assert list(enrich(_tickets(spark)).columns) == ENRICHMENT_COLUMNS + ["reply_error", "enum_ok"]


def test_model_function_runs_per_batch(spark):
    def fake_model(prompts: pd.Series) -> pd.Series:
        def one(p):
            tid = p.split("Ticket ID: ")[1].split("\n")[0]
            if tid == "T3":
                return "sorry"
            return "```json\n" + json.dumps({
                "issue_category": "REFUND_DELAY", "sentiment": "NEUTRAL", "urgency": "LOW",
                "requires_human_followup": False, "root_cause_hint": "r", "customer_summary": f"sum {tid}",
                "pii_redacted_message": "mail me at a.b@c.com", "next_best_action": "a"}) + "\n```"
        return prompts.map(one)

    out = {r.ticket_id: r for r in enrich(_tickets(spark), reply_fn=fake_model).collect()}
    assert out["T1"].customer_summary == "sum T1" and out["T1"].pii_redacted_message == "mail me at [REDACTED_EMAIL]"
    assert out["T3"].reply_error == "unparseable reply" and out["T3"].issue_category is None
    assert len(out) == 5


def test_strict_mode_fails_on_bad_reply(spark):
    schema = T.StructType(RAW_TICKETS.fields + [T.StructField("reply", T.StringType())])
    df = spark.createDataFrame([("T1", "O", "C", None, "E", "m", "n", "nonsense")], schema)
    with pytest.raises(Exception):
        enrich(df, reply="reply", strict=True).collect()


def test_prompt_and_embedding_text(spark):
    r = _tickets(spark).filter("ticket_id = 'T3'").select(ticket_prompt().alias("p")).collect()[0]
    assert r.p == ("Enrich this support ticket for downstream analytics.\n\nTicket ID: T3\nOrder ID: O3\n"
                   "Channel: WEB\nCustomer message: Please book the pickup for my return\nAgent notes: None")
    e = enrich(_tickets(spark)).filter("ticket_id = 'T4'").select(embedding_text().alias("t")).collect()[0]
    assert e.t.startswith("Issue category: GENERAL_QUERY. Summary: Customer reports general query on order O4.")
    assert e.t.endswith(". Customer message: What are your opening hours? Thanks")


def test_simulated_reply_is_built_once(spark):
    """Steps that name the reply several times refer to a column, not to copies of the whole expression."""
    from caseloom.sources import analog

    tickets = analog.event_tickets(spark, "/root/testdata/sf0.001").select("ticket_id", "reply")
    plan = tickets._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1


def test_tickets_of_one_file_are_dealt_to_many_tasks(spark):
    from caseloom.sources import analog

    tickets = analog.event_tickets(spark, "/root/testdata/sf0.001").select("ticket_id", "reply")
    assert tickets.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
