"""Pages put together are the report, whatever their size, with ties, equal rows and nulls."""

import random

import pytest
from pyspark.sql import functions as F

from caseloom.operators import paging, reports
from caseloom.plans import queries

KEYS = [("risk", True), ("delay", True), ("order_id", False)]
SCHEMA = "order_id string, risk int, delay double, at timestamp_ntz, note string"


def rows(n=60):
    import datetime as dt

    rng = random.Random(1)
    return [(rng.choice([None, "A", "B", "C"]), rng.choice([None, 1, 2]), rng.choice([None, 0.1, 2.5, float("nan"), -1 / 3]),
             rng.choice([None, dt.datetime(2026, 1, 1, 10, 0, 0, 123456)]), rng.choice([None, "", "x"])) for _ in range(n)]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_pages_make_the_report(spark, size):
    data = rows(25 if size == 1 else 60) + [("A", 1, 0.1, None, "x")] * (3 if size == 1 else 30)  # more equal rows than a page holds
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    whole = df.orderBy(*paging._order(paging.keyset(df, KEYS))).collect()
    found = list(paging.pages(df, KEYS, size))
    assert [repr(r) for p, _ in found for r in p] == [repr(r) for r in whole] and all(len(p) <= size for p, _ in found)


def test_reading_goes_on_from_a_token(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    all_pages = list(paging.pages(df, KEYS, 9))
    again = list(paging.pages(df, KEYS, 9, all_pages[1][1]))
    assert [repr(p) for p, _ in again] == [repr(p) for p, _ in all_pages[2:]]
    assert list(paging.pages(df.limit(0), KEYS, 9)) == []


def test_a_page_is_a_limit_without_a_shuffle_of_the_report(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    first = paging.page(df, KEYS, 5)
    plan = paging.page(df, KEYS, 5, paging.token_of(df, KEYS, first.collect()))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "HashAggregate" not in plan


def test_high_risk_orders_by_pages(spark):
    d = "/root/testdata/sf0.001"
    m = queries.order_support_360(spark, d, with_similarity=False).filter("risk_flag").select(
        *reports.HIGH_RISK_COLUMNS, reports.urgency_rank().alias("rank")).cache()
    found = [r for p, _ in paging.pages(m, [("rank", False), ("delay_hours", True), ("order_id", False)], 1500) for r in p]
    assert len(found) == m.count() and sorted(map(repr, found)) == sorted(map(repr, m.collect()))
    order = [(r.rank, -r.delay_hours, r.order_id) for r in found]
    assert order == sorted(order)
    m.unpersist()
