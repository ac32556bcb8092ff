"""Plan shape guards: what the physical plans must keep at scale."""

import pytest

from caseloom.operators import kpis, mart, similarity
from caseloom.plans import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    frames = {"orders": Q.silver_orders(spark, SF), "shipments": Q.silver_shipments(spark, SF),
              "returns": Q.silver_returns(spark, SF), "enrichment": Q.ticket_enrichment(spark, SF),
              "embeddings": Q.ticket_embeddings(spark, SF)}
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    return {n: spark.read.parquet(f"{root}/{n}") for n in frames}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_mart_shuffles_each_input_once(stored, no_broadcast):
    sim = similarity.top_matches(stored["embeddings"], stored["enrichment"], num_blocks=2)
    m = mart.order_support_360(stored["orders"], stored["shipments"], stored["returns"], stored["enrichment"],
                               sim, hot_key_rows=None)
    plan = _plan(m)
    exchanges = [ln.split("Exchange hashpartitioning(")[1].split(",")[0] for ln in plan.splitlines()
                 if "Exchange hashpartitioning(" in ln]
    keys = sorted(k.split("#")[0] for k in exchanges)
    # each input once by its order key; the chain adds no exchange after a join
    # (the ticket side: by ticket_id for its top match, then by order key)
    assert keys.count("order_id") == 1 and keys.count("_rk0") == 1 and keys.count("_rk1") == 1, keys
    assert keys.count("_rk2") == 1, keys
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_kpis_prune_columns_and_push_the_filter(spark, stored):
    m = mart.order_support_360(stored["orders"], stored["shipments"], stored["returns"], stored["enrichment"],
                               None, hot_key_rows=None)
    path = f"{stored['orders'].inputFiles()[0].rsplit('/', 2)[0]}/mart"
    m.write.mode("overwrite").parquet(path)
    plan = _plan(kpis.issue_kpis(spark.read.parquet(path)))
    assert "PushedFilters: [IsNotNull(has_ticket), EqualTo(has_ticket,true)]" in plan
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "customer_name" not in scan and "carrier" not in scan


def test_similarity_is_blocked(stored, no_broadcast):
    plan = _plan(similarity.top_matches(stored["embeddings"], stored["enrichment"], num_blocks=3))
    assert "FlatMapGroupsInPandas" in plan and "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
