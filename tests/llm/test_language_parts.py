"""Features and softmax of language identification against plain Python; a sample bounded over many languages."""

import math

import numpy as np
from pyspark.sql import functions as F

from caseloom.llm import language


def plain_mix(x):
    mask = (1 << 64) - 1
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
    return x ^ (x >> 31)


def plain_counts(raw, buckets):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    out = [0] * buckets
    for n in language.GRAMS:
        for i in range(len(low) - n + 1):
            gram = 0
            for b in low[i:i + n]:
                gram = gram * 257 + b + 1
            out[plain_mix((gram + (n << 40)) & ((1 << 64) - 1)) & (buckets - 1)] += 1
    return out


def test_subwords_by_definition():
    for text in ("", "a", "AbC", "été là-bas", "x" * 50, "The quick brown fox"):
        raw = text.encode()
        got = language.subword_counts(np.frombuffer(raw, np.uint8), 1 << 12)
        assert got.sum() == sum(max(0, len(raw) - n + 1) for n in language.GRAMS)
        assert got.tolist() == plain_counts(raw, 1 << 12)


def test_long_texts_are_counted_in_steps(monkeypatch):
    raw = np.frombuffer(("many words " * 500).encode(), np.uint8)
    whole = language.subword_counts(raw, 1 << 12)
    monkeypatch.setattr(language, "STEP_BYTES", 97)
    assert np.array_equal(language.subword_counts(raw, 1 << 12), whole)


def test_prediction_is_the_softmax_of_the_mean_embedding(spark):
    rng = np.random.default_rng(1)
    model = language.LanguageModel(["aa", "bb", "cc"], rng.normal(size=(256, 4)), rng.normal(size=(4, 3)), rng.normal(size=3), 0.7, 0.5)
    texts = ["one two", "trois", "", None, "123 !", "ein Wort " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in language.predict(df, model).collect()}
    for i, text in enumerate(texts):
        if not any(c.isalpha() for c in text or ""):
            assert (got[i].lang_pred, got[i].score, got[i].accepted) == ("und", 0.0, False)
            continue
        counts = language.subword_counts(np.frombuffer(text.encode(), np.uint8), 256)
        mean = sum(n * model.embeddings[b] for b, n in enumerate(counts)) / counts.sum()
        z = [math.exp((mean @ model.weights[:, k] + model.bias[k]) / 0.7) for k in range(3)]
        best = max(range(3), key=lambda k: z[k])
        assert got[i].lang_pred == model.languages[best] and math.isclose(got[i].score, z[best] / sum(z), rel_tol=1e-9)
        assert got[i].accepted == (got[i].score >= 0.5)


def test_the_sample_is_bounded_over_all_languages(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("l"), F.col("id") % 60).alias("lang"),
                                    F.concat(F.lit("text number "), F.col("id")).alias("text"))
    got = language.sample_features(rows, per_language=40, texts=300)
    assert 150 < len(got) < 450 and len({r[0] for r in got}) > 50
