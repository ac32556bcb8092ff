"""Fitted embeddings against numpy's singular value decomposition, and term weights against plain counts."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from caseloom.functions.text import embedding_text
from caseloom.operators import latent
from caseloom.plans import queries

SLOTS = 512


def plain_rows(texts, slots=SLOTS):
    """(TF-IDF rows, idf) by definition."""
    counts = np.zeros((len(texts), slots))
    for i, t in enumerate(texts):
        for tok, n in Counter(re.findall(r"[^\W_]+", (t or "").lower())).items():
            counts[i, int(hashlib.md5(tok.encode()).hexdigest()[:8], 16) % slots] += n
    df = (counts > 0).sum(axis=0)
    idf = np.where(df > 0, np.log((len(texts) + 1) / (df + 1)) + 1, 0)
    rows = counts * idf
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1), idf


def topics(n):
    rng = np.random.default_rng(1)
    words = [[f"t{k}w{i}" for i in range(30)] for k in range(6)]
    return [" ".join(rng.choice(words[k], 25 - 3 * k)) + " common words" for k in rng.choice(6, n, p=[.35, .25, .15, .1, .1, .05])]


def test_directions_equal_the_svd(spark):
    texts = topics(300)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").repartition(5)
    model = latent.fit(df, F.col("text"), dim=6, rounds=25, slots=SLOTS)
    rows, idf = plain_rows(texts)
    _, s, vt = np.linalg.svd(rows, full_matrices=False)
    assert np.allclose(model.idf, idf) and np.allclose(model.strength, s[:6], rtol=1e-6)
    for k in range(6):
        assert abs(abs(model.basis[:, k] @ vt[k]) - 1) < 1e-6 and model.basis[np.abs(model.basis[:, k]).argmax(), k] > 0
    got = np.array([r.v for r in df.select("id", model.vector(F.col("text")).alias("v")).orderBy("id").collect()])
    assert np.allclose(got, rows @ model.basis)


def test_subspace_of_the_conversations(spark):
    """On the table: the leading subspace and the cosines of all pairs in it equal numpy's."""
    enrichment = queries.conversation_enrichment(spark, "/root/testdata/sf0.01")
    texts = [r.t for r in enrichment.select("ticket_id", embedding_text().alias("t")).orderBy("ticket_id").collect()]
    model = latent.fit(enrichment, embedding_text(), dim=8, rounds=30, slots=SLOTS)
    rows, _ = plain_rows(texts)
    _, s, vt = np.linalg.svd(rows, full_matrices=False)
    k = 8 - int(np.argmax((s[:8] / s[1:9])[::-1] > 1.02))  # the last wide gap: the subspace before it is well defined
    assert k >= 2 and np.allclose(model.strength[:k], s[:k], rtol=1e-3)
    angles = np.linalg.svd(vt[:k] @ model.basis[:, :k])[1]
    assert angles.min() > 0.999


def test_term_weights(spark):
    texts = ["a b a", "b c", None, "", "É é"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(latent.token_slots(F.col("text"), SLOTS).alias("places"))
    got = {r.slot: (r.texts, r.idf) for r in latent.term_weights(df).collect()}
    slot = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % SLOTS
    want = Counter(slot(t) for t in ["a", "b", "b", "c", "é"])
    assert {k: v[0] for k, v in got.items()} == want
    assert all(math.isclose(v[1], math.log(6 / (v[0] + 1)) + 1) for v in got.values())


def test_odd_texts(spark, workdir):
    df = spark.createDataFrame([(0, "alpha beta"), (1, None), (2, ""), (3, "alpha beta"), (4, "x " * 100000), (5, "unseen")], "id int, text string")
    model = latent.fit(df.where("id < 5"), F.col("text"), dim=7, slots=SLOTS)
    assert np.count_nonzero(model.strength) == 2 and not model.basis[:, 2:].any()  # two different texts: rank 2
    model.save(spark, f"{workdir}/latent")
    again = latent.LatentModel.load(spark, f"{workdir}/latent")
    assert np.array_equal(again.basis, model.basis) and np.array_equal(again.idf, model.idf)
    got = {r.id: r.v for r in df.select("id", again.vector(F.col("text")).alias("v")).collect()}
    assert got[1] is None and got[2] == got[5] == [0.0] * 7 and got[0] == got[3] and len(got[4]) == 7
    assert df.limit(0).select(again.vector(F.col("text"))).collect() == []
    none = latent.fit(df.limit(0), F.col("text"), dim=3, slots=SLOTS)
    assert not none.basis.any() and none.basis.shape == (SLOTS, 3)
