"""Every significant passage counts: the sum statistic, and scores that grow with more passages."""

import math
import random

import pytest
from pyspark.sql import functions as F

from caseloom.llm import toxicity
from caseloom.llm.frames import table

SF = "/root/testdata/sf0.01"


def test_one_segment_stands_on_its_own_scale():
    model = toxicity.ToxicityModel({"a": 1.0}, rate=0.8, log_k=-1.0)
    assert model.evidence([7.0], 50) == pytest.approx(0.8 * 7 + 1 - math.log(50))
    assert model.evidence([], 50) < model.evidence([0.1], 10 ** 6) + 12


def test_sum_statistic_by_its_formula():
    rng = random.Random(1)
    model = toxicity.ToxicityModel({"a": 1.0}, rate=1.3, log_k=0.5)
    for _ in range(200):
        scores, n = [rng.uniform(0, 20) for _ in range(rng.randrange(1, 12))], rng.randrange(1, 2000)
        x = [1.3 * s - 0.5 - math.log(n) for s in sorted(scores, reverse=True)]
        tries = [x[0]]
        for r in range(2, len(x) + 1):
            t = sum(x[:r])
            if x[r - 1] <= 0:
                break
            p = math.exp(-t) * t ** (r - 1) / (math.factorial(r) * math.factorial(r - 1)) if t > 0 else 1.0
            tries.append(min(-math.log(p) if p else math.inf, t) - (r - 1) * math.log(2))
        assert model.evidence(scores, n) == pytest.approx(max(tries))


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_more_passages_never_lower_the_score(spark, model):
    """Toxic passages, alike and different, are added one by one to a clean text."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    both = docs.join(labels, "doc_id").select("text", "toxic").where(F.col("text").isNotNull()).collect()
    clean = next(r.text for r in both if r.toxic == 0 and not model.found(r.text)[0])
    passages = []
    for r in both:
        words = toxicity.tokens(r.text)
        passages += [" ".join(words[a:e]) for s, a, e in model.segments(words) if r.toxic == 1 and model.tail(s, len(words)) < 1e-4]
    passages = sorted(set(passages))
    assert len(passages) > 3
    rng = random.Random(2)
    for _ in range(20):
        text, last = clean, -math.inf
        alike = rng.choice(passages)
        for i in range(10):
            text += " . " + (alike if i % 2 else rng.choice(passages)) + " . " + " ".join(["zzz"] * 8)
            now = model.evidence(*model.found(text))
            assert now >= last, i
            last = now
        assert model.score(*model.found(text)) > 0.9


def test_no_token_of_the_sample_is_cut_off(spark):
    """30,000 tokens that only toxic texts use are all learnt."""
    rows = [(i, " ".join(f"{'bad' if i % 2 else 'good'}{k}" for k in range(30_000))) for i in range(1, 61)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, toxic int")
    assert len(toxicity.fit(df, labels).odds) == 30_000


def test_dropping_keeps_columns_with_clashing_names(spark, model):
    rows = [(1, "clean words", "en", "s", 3), (None, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "word " * 100_000, "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for c in ("score", "toxic", "kind", "best", "n", "word", "__text", "__id", "evidence", "n_passages", "id"):
        df = df.withColumn(c, F.lit("clash"))
    kept = toxicity.keep_clean(df, model)
    assert kept.columns == df.columns and kept.count() == len(rows)
    assert toxicity.keep_clean(df.limit(0), model).collect() == []
