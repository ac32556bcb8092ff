"""Patterns against plain Python, and the brief that lists them."""

import datetime as dt
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from caseloom.operators import brief, kpis, patterns, reports

SCHEMA = "order_id string, city string, order_amount double, delay_hours double, refund_amount double, ticket_id string, issue_category string, has_ticket boolean, order_date timestamp_ntz"


def mart_rows():
    rng = random.Random(5)
    rows = []
    for i in range(900):
        week = rng.choice(range(10))
        city, cat = rng.choice(["Goa", "Pune", "Agra", None]), rng.choice(["LATE", "BROKEN", "LOST", None])
        if week == 9 and rng.random() < 0.6:
            cat = "LOST"
        if city == "Goa" and rng.random() < 0.5:
            cat = "BROKEN"
        date = dt.datetime(2026, 3, 2) + dt.timedelta(days=7 * week + rng.randrange(7), hours=5)
        rows.append((f"O{i}", city, 10.0, 40.0 + rng.random() if cat == "LATE" else float(rng.randrange(30)), 0.0, f"T{i}", cat, rng.random() < 0.95, date))
    return rows


def expected(rows):
    own = [r for r in rows if r[7]]
    n = len(own)
    out = {}

    def add(kind, city, cat, tickets, observed, exp, dev):
        if dev > 0 and tickets >= 5 and round((observed - exp) / dev, 4) >= 2:
            out[kind, city, cat] = (tickets, pytest.approx(observed, abs=1e-4), pytest.approx(exp, abs=1e-4), pytest.approx((observed - exp) / dev, abs=1e-3))

    city, cat = Counter(r[1] for r in own), Counter(r[6] for r in own)
    for (c, k), t in Counter((r[1], r[6]) for r in own).items():
        e = city[c] * cat[k] / n
        add("hotspot", c, k, t, t, e, math.sqrt(e))
    delays = defaultdict(list)
    for r in own:
        delays[r[6]].append(r[3])
    mean = sum(r[3] for r in own) / n
    var = sum(r[3] ** 2 for r in own) / n - mean ** 2
    for k, d in delays.items():
        add("delay", None, k, len(d), sum(d) / len(d), mean, math.sqrt(var / len(d)))
    monday = lambda r: (r[8] - dt.timedelta(days=r[8].weekday())).date()
    last = max(map(monday, own))
    for k in cat:
        t = sum(r[6] == k and monday(r) == last for r in own)
        e = sum(r[6] == k and last - dt.timedelta(days=56) <= monday(r) < last for r in own) / 8
        add("trend", None, k, t, t, e, math.sqrt(e))
    return out


def test_patterns_stand_out_from_what_is_expected(spark):
    rows = mart_rows()
    got = {(r.pattern, r.city, r.issue_category): (r.tickets, r.observed, r.expected, r.score)
           for r in patterns.issue_patterns(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == expected(rows)
    assert {("hotspot", "Goa", "BROKEN"), ("delay", None, "LATE"), ("trend", None, "LOST")} <= set(got)


def test_nothing_to_find(spark):
    df = spark.createDataFrame(mart_rows(), SCHEMA)
    assert patterns.issue_patterns(df.limit(0)).collect() == []
    assert patterns.issue_patterns(df.withColumn("has_ticket", F.lit(False))).collect() == []
    undated = patterns.issue_patterns(df.withColumn("order_date", F.lit(None).cast("timestamp_ntz"))).collect()
    assert {r.pattern for r in undated} == {"hotspot", "delay"}


def test_the_brief_lists_them(spark):
    m = spark.createDataFrame(mart_rows(), SCHEMA)
    k, h = reports.brief_kpi_top(kpis.issue_kpis(m)), reports.brief_hotspot_top(kpis.city_issue_hotspots(m))
    plain = brief.daily_brief(k, h).first().brief
    text = brief.daily_brief(k, h, pattern_lines=patterns.pattern_lines(patterns.issue_patterns(m), 3)).first().brief
    head, listed = text.split("\n\n## Patterns\n\n")
    assert head == plain and len(listed.splitlines()) == 3 and "LATE waits 40.5 hours on average against" in listed
    none = brief.daily_brief(k, h, pattern_lines=patterns.pattern_lines(patterns.issue_patterns(m.limit(0)))).first().brief
    assert none == plain
    asked = brief.daily_brief(k, h, lambda prompts: prompts, patterns.pattern_lines(patterns.issue_patterns(m), 3)).first().brief
    assert asked.endswith("\n\n## Patterns\n\n" + listed)
