"""Write the benchmark-derived raw support files (CSV and JSON lines) into a
folder, then run every stage of plans/jobs.py on them, end to end.

Usage: python tools/run_jobs_demo.py [sf_dir] [root_dir]
Prints the row counts each stage wrote.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from caseloom.config import PipelineConfig, build_session  # noqa: E402
from caseloom.plans.jobs import run_all  # noqa: E402
from caseloom.sinks.writers import export_csv, export_json  # noqa: E402
from caseloom.sources import analog  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    root = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="caseloom-jobs-", dir="/tmp")
    spark = build_session("local[8]", shuffle_partitions=16)
    cfg = PipelineConfig(root=root)
    raw = {
        "orders": analog.raw_orders(spark, sf_dir),
        "shipments": analog.raw_shipments(spark, sf_dir),
        "returns": analog.raw_returns(spark, sf_dir),
        "products": analog.raw_products(spark, sf_dir),
    }
    for name, df in raw.items():
        export_csv(df, cfg.path("raw", name))
    tickets = analog.event_tickets(spark, sf_dir).drop("reply")
    export_json(tickets, cfg.path("raw", "support_tickets"))
    t0 = time.time()
    counts = run_all(spark, cfg)
    print(json.dumps({"root": root, "seconds": round(time.time() - t0, 1), "rows": counts}))


if __name__ == "__main__":
    main()
