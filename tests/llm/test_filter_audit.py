"""The filter audit against applying the filters one after the other."""

import random
import re
from collections import defaultdict
from itertools import permutations
from math import factorial

import duckdb
from pyspark.sql import functions as F

from caseloom.llm import filter_audit as fa

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"


def fails(doc, least):
    i, text, _ = doc
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, bad in zip("ABCDE", (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        re.search(r"[#$%&*|]", text) is not None, i is not None and text in least and least[text] < i)) if bad}


def expected(docs, labels):
    docs = [(i, t or "", p or "") for i, t, p in docs]
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, x in labels if x == 1} - {None}
    failing = [(p, i, fails((i, t, p), least)) for i, t, p in docs]
    out, sums = {}, defaultdict(int)
    for part in {p for p, _, _ in failing}:
        for order in permutations("ABCDE"):
            left = [(i, f) for p, i, f in failing if p == part]
            everything = left
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                redundant = sum(letter in f for _, f in everything) - len(gone)
                left = [(i, f) for i, f in left if letter not in f]
                out[part, "".join(order), step] = (len(left), len(gone), redundant, sum(f == {letter} for _, f in everything),
                                                   sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
                sums[part, letter] += len(gone)
    return {k: (*v, sums[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


def test_lattice_counts_orders():
    edges = fa.lattice(5)
    assert len(edges) == 80
    for state, bit, orders in edges:
        k = bin(state).count("1")
        assert orders == factorial(k) * factorial(4 - k) and not state & bit
    assert sum(w for s, _, w in edges if s == 0) == sum(w for s, b, w in edges if s | b == 31) == 120


def test_query_and_sql_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    want = expected([tuple(r) for r in read("documents").select("doc_id", "text", "lang").collect()], [tuple(r) for r in read("labels").collect()])
    assert got(fa.op13_filter_audit(spark, sf)) == want
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(fa.OP13_SQL)
    names = [d[0] for d in cur.description]
    sql = [dict(zip(names, r)) for r in cur.fetchall()]
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in sql} == want


def odd():
    rng = random.Random(6)
    words = ["a", "b", "C", "#", "é", "DD"]
    texts = [None, "", " \n\t", "x" * 300000, *(" ".join(rng.choices(words, k=rng.choice([3, 150, 250]))) for _ in range(12)),
             " ".join(f"w{i}" for i in range(205)), " ".join(f"w{i}" for i in range(199))]
    docs = [(rng.choice([None, *range(30)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(150)]
    return docs + docs[:20], [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [None, *range(0, 30, 2), *range(0, 30, 3)]]


def test_odd_rows(spark):
    docs, labels = odd()
    df = spark.createDataFrame([(i, t, p, "s", 1) for i, t, p in docs], DOCS)
    for c in ("part", "failed", "digest", "first", "copy", "quality", "toxic", "good", "state", "bit", "n", "t", "c", "d", "of"):
        df = df.withColumn(c, F.lit("clash"))
    marks = spark.createDataFrame(labels, LABELS).withColumn("part", F.lit("clash")).withColumn("of", F.lit("clash"))
    assert got(fa.audit(fa.failures(df, marks))) == expected(docs, labels)
    assert fa.audit(fa.failures(df.limit(0), marks)).collect() == []
    assert got(fa.audit(fa.failures(df, marks.limit(0)))) == expected(docs, [])


def test_other_numbers_of_filters(spark):
    rows = spark.createDataFrame([("p", 1, True, False), ("p", 3, False, True), ("p", 0, True, True), ("q", 2, False, False)],
                                 "part string, failed int, good boolean, toxic boolean")
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in fa.audit(rows, "xy").collect()}
    assert out["p", "xy", 1] == (1, 2, 0, 3) and out["p", "xy", 2] == (1, 0, 1, 1)
    assert out["p", "yx", 1] == (2, 1, 0, 1) and out["p", "yx", 2] == (1, 1, 1, 3) and out["q", "yx", 1] == (0, 1, 0, 2)
