"""Increments equal the full rebuild; parts merge to the same aggregates."""

import datetime as dt
import glob
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_jobs import write_raw

from caseloom.config import PipelineConfig
from caseloom.operators import incremental, kpis, mergeable
from caseloom.plans import jobs, queries
from caseloom.sources.raw import read_table


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def gold(spark, cfg):
    m = read_table(spark, cfg.path("gold", "order_support_360"))
    return [rows(m.drop(mergeable.BUCKET)), *(rows(read_table(spark, cfg.path("gold", t))) for t in ("issue_kpis", "city_issue_hotspots"))]


def append(spark, cfg, layer, table, change, where):
    """Copies of some stored rows, changed, as new rows of the table; the new rows' orders."""
    stored = read_table(spark, cfg.path(layer, table))
    new = change(stored.where(where)).select(*stored.columns)
    keys = [r.order_id for r in new.collect()]
    new.write.mode("append").parquet(cfg.path(layer, table))
    return keys


def test_three_increments_equal_the_rebuild(spark, workdir):
    write_raw(workdir)
    cfg = PipelineConfig(root=workdir, gold_buckets=16)
    jobs.run_silver(spark, cfg)
    jobs.run_tickets(spark, cfg)
    jobs.run_gold(spark, cfg)
    path = cfg.path("gold", "order_support_360")
    full = replace(cfg, gold="gold_full", gold_buckets=None)

    def check(keys):
        files = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/{mergeable.BUCKET}=*/*.parquet")}
        changed = spark.createDataFrame([(k,) for k in keys], "order_id string")
        counts = jobs.run_gold_increment(spark, cfg, changed)
        jobs.run_gold(spark, full)
        assert gold(spark, cfg) == gold(spark, full)
        kept = [f for f in files if os.path.exists(f) and os.path.getmtime(f) == files[f]]
        assert len({os.path.dirname(f) for f in files}) - len({os.path.dirname(f) for f in kept}) <= counts["buckets"]
        return counts

    # a second shipment of one order, a new order with a null key, then a ticket that changes best matches
    keys = append(spark, cfg, "silver", "shipments", lambda d: d.withColumn("delay_hours", F.lit(99.5)), "order_id = 'O003'")
    assert check(keys)["buckets"] == 1
    keys = append(spark, cfg, "silver", "orders", lambda d: d.withColumn("order_id", F.when(F.col("order_id") == "O004", "O777")), "order_id in ('O004', 'O005')")
    keys += append(spark, cfg, "silver", "returns", lambda d: d.withColumn("return_id", F.lit("R9")), "order_id = 'O010'")
    assert set(keys) == {None, "O777", "O010"}
    check(keys)
    stored = read_table(spark, cfg.path("model", "ticket_similarity"))
    worse = stored.withColumn("similarity_score", F.when(F.col("ticket_id") == "T007", 0.125).otherwise(F.col("similarity_score")))
    worse.write.parquet(cfg.path("model", "sim_next"))
    read_table(spark, cfg.path("model", "sim_next")).write.mode("overwrite").parquet(cfg.path("model", "ticket_similarity"))
    counts = check([])
    assert counts["changed_orders"] == 1 and counts["buckets"] == 1
    assert check([])["buckets"] == 0  # nothing new: nothing is written


def test_new_files_name_the_changed_orders(spark, workdir):
    first = spark.createDataFrame([("A",), ("B",)], "order_id string")
    first.write.parquet(f"{workdir}/t")
    for f in glob.glob(f"{workdir}/t/*.parquet"):
        os.utime(f, (1_700_000_000, 1_700_000_000))
    spark.createDataFrame([("B",), (None,)], "order_id string").write.mode("append").parquet(f"{workdir}/t")
    new = incremental.changed_since(read_table(spark, f"{workdir}/t"), dt.datetime(2024, 1, 1))
    assert sorted(map(str, (r[0] for r in incremental.changed_orders(new, new).collect()))) == ["B", "None"]


@pytest.fixture(scope="module")
def mart(spark):
    m = queries.order_support_360(spark, "/root/testdata/sf0.001", fanout=True, with_similarity=False).cache()
    yield m
    m.unpersist()


def test_bucket_parts_merge_to_the_aggregates(spark, mart):
    m = mart.withColumn(mergeable.BUCKET, mergeable.order_bucket(7))
    parts, orders = mergeable.bucket_parts(m), mergeable.category_orders(m)
    assert rows(mergeable.issue_kpis(parts, orders)) == rows(kpis.issue_kpis(mart))
    assert rows(mergeable.city_issue_hotspots(parts)) == rows(kpis.city_issue_hotspots(mart))


def test_daily_parts_merge_from_files(spark, mart, workdir):
    """Two stored files of days, with numbers given at different times, count distinct orders exactly."""
    cut = F.col("order_date") < F.lit(dt.datetime(1995, 6, 1))
    known = mergeable.order_numbers(mart.where(cut))
    mergeable.daily_parts(mart.where(cut), known).write.parquet(f"{workdir}/parts")
    numbers = mergeable.order_numbers(mart, known)
    assert numbers.count() == numbers.select("number").distinct().count() == mart.where("order_id is not null").select("order_id").distinct().count()
    mergeable.daily_parts(mart.where(~cut), numbers).write.mode("append").parquet(f"{workdir}/parts")
    # the same orders once more on other days: counted once in the whole, once per day apart
    mergeable.daily_parts(mart, numbers, F.lit(dt.date(2030, 1, 1))).write.mode("append").parquet(f"{workdir}/parts")
    parts = read_table(spark, f"{workdir}/parts")
    whole = {r["_k0"]: r.impacted_orders for r in mergeable.merged(parts, F.col("issue_category")).collect()}
    want = {r.issue_category: r.impacted_orders for r in kpis.issue_kpis(mart).collect()}
    assert whole == want
    days = mart.where("has_ticket").groupBy(F.to_date("order_date"), "issue_category").agg(F.count_distinct("order_id").alias("n"))
    by_day = mergeable.merged(parts, F.col("day"), F.col("issue_category")).agg(F.sum("impacted_orders")).first()[0]
    assert by_day == days.agg(F.sum("n")).first()[0] + sum(want.values())
    assert mergeable.merged(parts.limit(0), F.col("issue_category")).collect() == []


def test_orders_of_a_day_share_their_bitmaps(spark):
    """Numbers that follow the day put a day's orders in one or two ranges, however many tasks numbered them."""
    from pyspark.sql import functions as F

    from caseloom.operators import mergeable

    days, each = 20, 40
    m = spark.range(days * each).repartition(16).select(
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("order_id"), F.expr(f"date_add(date'2024-01-01', cast(id % {days} as int))").alias("order_date"),
        F.lit("A").alias("issue_category"), F.col("id").cast("string").alias("ticket_id"), F.lit(True).alias("has_ticket"),
        *[F.lit(1.0).alias(c) for c in mergeable.MEANS]).withColumn("order_date", F.when(F.col("order_id") != "o7", F.col("order_date")))
    m = m.unionByName(m.limit(5))
    numbers = mergeable.order_numbers(m, by=F.to_date("order_date"))
    assert numbers.count() == numbers.select("number").distinct().count() == numbers.select("order_id").distinct().count() == days * each
    parts = mergeable.daily_parts(m, numbers)
    assert parts.count() <= 2 * (days + 1)
    got = mergeable.merged(parts, F.col("issue_category")).first()
    assert (got["ticket_count"], got["impacted_orders"]) == (days * each + 5, days * each)
    again = mergeable.order_numbers(m, known=numbers.limit(100), by=F.to_date("order_date"))
    assert again.count() == again.select("order_id").distinct().count() == days * each
