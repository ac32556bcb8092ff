"""The streamed last records equal the batch answer, over restarts, repeats and late records."""

import json
import random

from caseloom.config import PipelineConfig
from caseloom.operators import standardize
from caseloom.sources.raw import read_raw_json, read_table
from caseloom.streaming.latest import BUCKET, latest_tickets, replace_tickets, start_latest_tickets


def write(root, name, records):
    import os

    os.makedirs(f"{root}/raw/support_tickets", exist_ok=True)
    with open(f"{root}/raw/support_tickets/{name}.jsonl", "w") as fh:
        fh.writelines(json.dumps(r) + "\n" for r in records)


def record(rng):
    day = rng.choice([None, 1, 2, 3, 20])
    return {"ticket_id": rng.choice([None, *(f"T{i}" for i in range(12))]), "order_id": "O1", "customer_id": "C1", "channel": "web",
            "created_at": None if day is None else f"2026-03-{day:02d}T08:00:00", "customer_message": f"text {rng.randrange(5)}", "agent_notes": None}


def rows(df):
    return sorted(map(repr, df.collect()))


def test_stream_equals_batch_over_restarts(spark, workdir):
    rng = random.Random(3)
    cfg = PipelineConfig(root=workdir)
    for step in range(3):
        batch = [record(rng) for _ in range(15)]
        write(workdir, f"a{step}", batch)
        write(workdir, f"b{step}", batch[:4] + [record(rng)])  # records sent again
        q = start_latest_tickets(spark, cfg, buckets=4, max_files_per_trigger=1)
        q.awaitTermination()
        want = latest_tickets(standardize.standardize_tickets(read_raw_json(spark, cfg.path("raw", "support_tickets"))))
        got = read_table(spark, cfg.path("silver", "latest_tickets")).drop(BUCKET)
        assert rows(got) == rows(want.select(*got.columns))
    q = start_latest_tickets(spark, cfg, buckets=4)  # no new file: nothing changes
    q.awaitTermination()
    assert rows(read_table(spark, cfg.path("silver", "latest_tickets")).drop(BUCKET)) == rows(got)


def test_a_batch_run_twice_writes_the_same_rows(spark, workdir):
    first = spark.createDataFrame([("A", "x"), ("B", "y"), (None, "n")], "ticket_id string, note string")
    replace_tickets(first, f"{workdir}/t", 3)
    change = spark.createDataFrame([("B", "z"), ("C", "c")], "ticket_id string, note string")
    for _ in range(2):
        replace_tickets(change, f"{workdir}/t", 3)
        assert {(r.ticket_id, r.note) for r in read_table(spark, f"{workdir}/t").collect()} == {("A", "x"), ("B", "z"), (None, "n"), ("C", "c")}
    replace_tickets(change.limit(0), f"{workdir}/t", 3)
    assert read_table(spark, f"{workdir}/t").count() == 4
