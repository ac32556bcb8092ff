"""Whole runs appear at once; raw rows that cannot be read are set aside."""

import os

import pytest
from test_jobs import write_raw

from caseloom.config import PipelineConfig
from caseloom.plans import jobs, publish
from caseloom.sources.raw import read_table, read_with_quarantine


def tables(spark, cfg):
    return {n: sorted(map(repr, read_table(spark, cfg.path(layer, n)).collect())) for layer, n in (
        ("silver", "orders"), ("model", "ticket_similarity"), ("gold", "order_support_360"), ("gold", "issue_kpis"))}


def test_readers_see_whole_runs(spark, workdir):
    write_raw(workdir)
    cfg = PipelineConfig(root=workdir, database="published_runs")
    assert publish.published(spark, cfg) is None
    counts = publish.run_and_publish(spark, cfg)
    first = publish.published(spark, cfg)
    seen = tables(spark, first)
    assert len(seen["order_support_360"]) == counts["order_support_360"] == spark.table("published_runs.order_support_360").count()

    with open(f"{workdir}/raw/orders/part-1.csv", "w") as fh:  # a new order arrives
        fh.write(open(f"{workdir}/raw/orders/part-0.csv").readline())
        fh.write("O999,C1,Name,P1,Prod,kitchen,2026-03-01T10:00:00,Pune,1,10.5,10.5,paid\n")

    def broken(spark, cfg, **kwargs):
        jobs.run_silver(spark, cfg)
        jobs.run_tickets(spark, cfg)
        assert publish.published(spark, cfg=PipelineConfig(root=workdir)) == publish.of_run(PipelineConfig(root=workdir), os.path.basename(first.root))
        raise RuntimeError("gold failed")

    with pytest.raises(RuntimeError):
        publish.run_and_publish(spark, cfg, stages=broken)
    assert publish.published(spark, cfg) == first and tables(spark, first) == seen
    assert spark.table("published_runs.order_support_360").count() == counts["order_support_360"]

    publish.run_and_publish(spark, cfg)
    second = publish.published(spark, cfg)
    assert second != first and len(tables(spark, second)["orders"]) == len(seen["orders"]) + 1
    assert tables(spark, first) == seen  # a reader that began before reads on
    assert spark.table("published_runs.order_support_360").count() == counts["order_support_360"] + 1
    assert publish.runs(spark, cfg).count() == 2


def test_unreadable_rows_are_set_aside(spark, workdir):
    write_raw(workdir)
    header = open(f"{workdir}/raw/orders/part-0.csv").readline()
    bad = ["O100,C1,too,few", "O101,C1,Name,P1,Prod,kitchen,2026-03-01T10:00:00,Pune,1,10.5,10.5,paid,one,more"]
    with open(f"{workdir}/raw/orders/part-1.csv", "w") as fh:
        fh.write(header + "\n".join([bad[0], "O102,C1,Name,P1,Prod,kitchen,2026-03-01T10:00:00,Pune,x,10.5,10.5,paid", bad[1]]) + "\n")
    lines = ['{"ticket_id": "T900", "order_id"', '["no", "object"]', "plain text"]
    with open(f"{workdir}/raw/support_tickets/part-1.jsonl", "w") as fh:
        fh.write('{"ticket_id": "T901"}\n' + "\n".join(lines) + "\n")
    good, aside = read_with_quarantine(spark, f"{workdir}/raw/orders", "orders")
    assert good.count() == 31 and good.select("order_id").count() == 31
    assert {(r.record, os.path.basename(r.file), r.source_table) for r in aside.collect()} == {(b, "part-1.csv", "orders") for b in bad}
    good, aside = read_with_quarantine(spark, f"{workdir}/raw/support_tickets", "support_tickets")
    assert good.count() == 21 and sorted(r.record for r in aside.collect()) == sorted(lines)

    cfg = PipelineConfig(root=workdir, quarantine=True)
    counts = jobs.run_silver(spark, cfg)
    assert (counts["orders"], counts["orders_quarantined"], counts["orders_bad_cells"]) == (31, 2, 1)
    assert (counts["support_tickets"], counts["support_tickets_quarantined"], counts["products_quarantined"]) == (21, 3, 0)
    assert read_table(spark, f"{workdir}/quarantine/orders").count() == 2
