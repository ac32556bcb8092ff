"""Whole inputs, hot keys on a grid, strict replies, the default rules, tables that follow their root."""

import collections

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from caseloom import config
from caseloom.config import PipelineConfig
from caseloom.functions.replies import parse_reply
from caseloom.operators import mart, similarity
from caseloom.operators.enrich import enrich
from caseloom.operators.skew import Side, hot_keys, left_join_chain, plain_chain
from caseloom.plans import queries as Q
from caseloom.schemas import RAW_TICKETS, REPLY_KEYS
from caseloom.sources import analog
from caseloom.sources.catalog import register_tables

SF = "/root/testdata/sf0.001"


def test_prompt_holds_every_character_of_every_turn(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").toPandas().sort_values(["conv_id", "turn", "text"])
    prompts = {r.ticket_id: r.prompt for r in Q.QUERIES["ticket_prompt"](spark, SF).collect()}
    for conv, part in turns.groupby("conv_id"):
        mine = part["role"] == "user"
        for texts in (part["text"][mine], part["text"][~mine]):
            if len(texts):
                assert "\n".join(texts).strip() in prompts[f"C{conv}"]


def test_every_line_ships(spark):
    assert analog.raw_shipments(spark, SF).count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()


def _rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("threshold", [1, 3, 7])
def test_grid_equals_plain_chain(spark, threshold):
    left = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", "z"), ("d", "x")], "k string, c string")
    one = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 0), ("e", 1)], "k string, v int")
    two = spark.createDataFrame([("a", i % 4) for i in range(11)] + [("d", i) for i in range(5)], "k string, w int")
    three = spark.createDataFrame([("a", "x", i) for i in range(8)] + [("b", "y", 1), ("c", "z", 2)], "k string, c3 string, u int")
    sides = [Side(one, "k"), Side(two, "k"), Side(three, "k", [("c", "c3")])]
    want = _rows(plain_chain(left, "k", sides))
    assert sum(want.values()) > 700
    assert _rows(left_join_chain(left, "k", sides, hot_threshold=threshold)) == want


def test_every_hot_key_is_found(spark):
    rows = spark.range(30_000).select((F.col("id") % 12_000).cast("string").alias("k"))  # more hot keys than the old cap
    assert hot_keys(rows, "k", 1).count() == 12_000
    assert hot_keys(rows, "k", 3) is None


def test_mart_is_the_same_with_every_key_hot(spark):
    args = (Q.silver_orders(spark, SF), Q.silver_shipments(spark, SF), Q.silver_returns(spark, SF), Q.ticket_enrichment(spark, SF))
    want = mart.order_support_360(*args, hot_key_rows=None)
    assert _rows(mart.order_support_360(*args, hot_key_rows=1)) == _rows(want)


def test_cluster_without_checkpoint_folder_is_an_error(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    session = type("Session", (), {"sparkContext": Context(), "conf": Conf()})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        config.checkpoint_dir(session)


# invented sentences of the eight kinds, each with cases near a word's limits
SENTENCES = {
    "DELIVERY_DELAY": ["Carrier is running behind, the parcel is two days late and no ETA was given", "Still waiting, transit keeps slipping"],
    "WRONG_ITEM_SENT": ["Item mismatch at packing, buyer wants the right one as replacement", "I got a different product than the plate I bought"],
    "RETURN_PICKUP_DELAY": ["Nobody came for the pickup of my return", "The reverse logistics team skipped its slot"],
    "DAMAGED_ITEM": ["The lamp came broken, please send a replacement", "Photos show damage; return or replacement asked"],
    "DELIVERY_EXCEPTION": ["The portal shows delivered but I never received it, proof of delivery disputed", "Parcel lost on the last mile"],
    "REFUND_DELAY": ["The refund was agreed but the money is not in my account", "Settlement is open since the return"],
    "REPLACEMENT_REQUEST": ["The kettle is faulty; a replacement instead of a refund, please", "Specifically asked for replacement instead of refund"],
    "PAYMENT_ISSUE": ["My card was charged twice", "Duplicate payment capture, finance must look"],
    "GENERAL_QUERY": ["Where do you discard plates for the occupied flat", "Which colours do you have"],
}


def test_default_rules_split_the_eight_kinds(spark):
    rows = [(f"T{k}-{i}", "O1", "C1", None, "WEB", text, "") for k, texts in SENTENCES.items() for i, text in enumerate(texts)]
    got = {r.ticket_id: r.issue_category for r in enrich(spark.createDataFrame(rows, RAW_TICKETS)).collect()}
    assert got == {t[0]: t[0][1:].rsplit("-", 1)[0] for t in rows}


GOOD = '{"issue_category":"REFUND_DELAY","sentiment":"NEUTRAL","urgency":"LOW","requires_human_followup":false,' \
       '"root_cause_hint":"r","pii_redacted_message":"m","customer_summary":"s","next_best_action":"a"}'


@pytest.mark.parametrize("reply,error", [
    (GOOD, None), ("```json\n" + GOOD + "\n```", None), (GOOD + " Hope this helps", "unparseable reply"), (GOOD + GOOD, "unparseable reply"),
    (GOOD + "," + GOOD, "unparseable reply"), (GOOD.replace('"', "'"), "unparseable reply"), ("[]", "unparseable reply"), ("", "unparseable reply"),
    (GOOD.replace('"r"', "null"), None), (GOOD.replace('"m"', "null"), "null pii_redacted_message"),
    (GOOD.replace(',"next_best_action":"a"', ""), "missing keys: next_best_action"), (None, "no reply"), ("{}", "missing keys: " + ",".join(REPLY_KEYS)),
])
def test_only_one_json_object_is_a_reply(spark, reply, error):
    r = parse_reply(spark.createDataFrame([(reply,)], "reply string")).first()
    assert r.reply_error == error
    assert r.enum_ok == (error is None or error.startswith("null") or error == "missing keys: next_best_action")


def test_strict_holds_under_count_and_projection(spark):
    df = spark.createDataFrame([("T1", "O", "C", None, "E", "m", "n")], RAW_TICKETS).withColumn("reply", F.lit("junk"))
    for use in (lambda d: d.count(), lambda d: d.select("ticket_id").collect()):
        with pytest.raises(Exception, match="bad model reply"):
            use(enrich(df, reply="reply", strict=True))


def test_model_is_told_the_format_and_called_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def model(prompts: pd.Series) -> pd.Series:
        seen.add(len(prompts))
        assert all("JSON object" in p and "next_best_action" in p for p in prompts)
        return prompts.map(lambda p: GOOD)

    rows = [(f"T{i}", "O", "C", None, "E", "m", "n") for i in range(20)]
    out = enrich(spark.createDataFrame(rows, RAW_TICKETS), reply_fn=model).filter("enum_ok").select("ticket_id", "issue_category")
    assert out.count() == 20 and seen.value == 20


def test_tables_follow_the_root(spark, tmp_path):
    for name, n in (("one", 1), ("two", 7)):
        cfg = PipelineConfig(root=str(tmp_path / name), database="follow_db")
        for layer, folder in (("model", "ticket_similarity"), ("gold", "order_support_360"), ("gold", "issue_kpis"), ("gold", "city_issue_hotspots")):
            spark.range(n).write.parquet(cfg.path(layer, folder))
        register_tables(spark, cfg, use=False)
        assert spark.table("follow_db.issue_kpis").count() == n
    spark.sql("DROP DATABASE follow_db CASCADE")


def test_files_added_later_are_read(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "part.parquet"))
    assert analog.table(spark, str(tmp_path), "part").count() == 3
    spark.range(2).write.mode("append").parquet(str(tmp_path / "part.parquet"))
    assert analog.table(spark, str(tmp_path), "part").count() == 5


@pytest.mark.parametrize("value", [0.0, 1.0])
def test_ties_list_only_the_wanted_places(value):
    n = 300
    block = pd.DataFrame({"ticket_id": [f"T{i:04d}" for i in range(n)], "issue_category": "X", "_uid": np.arange(n), "_m": 1})
    got = similarity._best_partners(block, block, np.full((n, n), value), 3)
    assert len(got) == 3 * n
    assert list(got[got["ticket_id"] == "T0005"]["matched_ticket_id"]) == ["T0000", "T0001", "T0002"]
    assert list(got[got["ticket_id"] == "T0001"]["matched_ticket_id"]) == ["T0000", "T0002", "T0003"]


def test_missing_summary_can_be_refused(spark):
    emb = spark.createDataFrame([("T1", "X", [1.0, 0.0]), ("T2", "X", [0.5, 0.5])], "ticket_id string, issue_category string, embedding array<double>")
    known = spark.createDataFrame([("T1", "s", "a", None)], "ticket_id string, customer_summary string, next_best_action string, created_at timestamp_ntz")
    assert similarity.top_matches(emb, known).filter("matched_ticket_summary is null").count() == 1
    with pytest.raises(Exception, match="no enrichment for ticket"):
        similarity.top_matches(emb, known, require_summaries=True).collect()


def test_scores_equal_the_column_cosine(spark):
    from caseloom.functions.vectors import cosine

    emb = Q.ticket_embeddings(spark, SF).select("ticket_id", "embedding")
    top = Q.QUERIES["ticket_similarity_top3"](spark, SF).select("ticket_id", "matched_ticket_id", "similarity_score")
    pairs = top.join(emb.withColumnRenamed("embedding", "a"), "ticket_id").join(
        emb.select(F.col("ticket_id").alias("matched_ticket_id"), F.col("embedding").alias("b")), "matched_ticket_id")
    assert pairs.filter(F.abs(F.round(cosine(F.col("a"), F.col("b")), 6) - F.col("similarity_score")) > 2e-6).count() == 0


def test_lost_tickets_and_unique_check(spark):
    orders = spark.createDataFrame([("O1", "C1"), ("O2", "C2"), ("O2", "C2")], "order_id string, customer_id string")
    tickets = spark.createDataFrame([("O1", "C1"), ("O1", "C9"), ("O7", "C1"), (None, "C1")], "order_id string, customer_id string")
    assert tuple(mart.lost_tickets(orders, tickets).first()) == (4, 3)
    with pytest.raises(ValueError, match="O2"):
        mart.assert_unique(orders, "order_id")


def test_bad_cells_are_counted(spark):
    from caseloom.operators import standardize
    from caseloom.schemas import RAW_RETURNS

    raw = spark.createDataFrame([("R1", "O1", "X", "1.5", "OPEN", "2026-03-01T10:00:00"), ("R2", "O1", "X", "abc", "OPEN", "soon"),
                                 ("R3", "O1", "X", "", "OPEN", None)], RAW_RETURNS)
    assert raw.agg(standardize.bad_cells(raw, standardize.standardize_returns(raw)).alias("n")).first().n == 2
