"""Print the physical plans of the pipeline's heavy steps, as a cluster would
plan them: inputs read from stored Parquet and broadcasts disabled, so every
join shows its shuffles.

Usage: python tools/show_plans.py [sf_dir] [scratch_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from caseloom.config import build_session  # noqa: E402
from caseloom.operators import kpis, mart, reports, similarity  # noqa: E402
from caseloom.plans import queries as Q  # noqa: E402


def summary(df, title):
    plan = df._jdf.queryExecution().executedPlan().toString()
    keep = [ln for ln in plan.splitlines()
            if any(k in ln for k in ("Exchange", "Join", "Aggregate", "Window", "FileScan", "FlatMapGroups",
                                     "TakeOrdered", "Union", "Generate"))]
    print(f"== {title}: {sum('Exchange' in k for k in keep)} exchanges")
    for ln in keep:
        print("  " + ln[:220])


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="caseloom-plans-", dir="/tmp")
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    stored = {
        "orders": Q.silver_orders(spark, sf_dir), "shipments": Q.silver_shipments(spark, sf_dir),
        "returns": Q.silver_returns(spark, sf_dir), "enrichment": Q.ticket_enrichment(spark, sf_dir),
        "embeddings": Q.ticket_embeddings(spark, sf_dir),
    }
    for name, df in stored.items():
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
    r = {n: spark.read.parquet(f"{scratch}/{n}") for n in stored}
    sim = similarity.top_matches(r["embeddings"], r["enrichment"], num_blocks=4)
    summary(sim, "ticket_similarity (blocked, exact)")
    sim.write.mode("overwrite").parquet(f"{scratch}/similarity")
    m = mart.order_support_360(r["orders"], r["shipments"], r["returns"], r["enrichment"],
                               spark.read.parquet(f"{scratch}/similarity"))
    summary(m, "order_support_360")
    m.write.mode("overwrite").parquet(f"{scratch}/mart")
    stored_mart = spark.read.parquet(f"{scratch}/mart")
    summary(kpis.issue_kpis(stored_mart), "issue_kpis (from the stored 360)")
    summary(reports.city_hotspots(stored_mart), "city_hotspots_top25")
    print("== issue_kpis scan of the stored 360 (column pruning, pushed filter):")
    kpis.issue_kpis(stored_mart).explain("formatted")


if __name__ == "__main__":
    main()
