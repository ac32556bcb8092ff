"""Language identification: averaged hashed subword embeddings and a linear softmax, with calibrated rejection.

A text is the mean of the embeddings of its subwords: byte n-grams of one to four bytes of the lower-cased text, hashed
into a fixed number of buckets. Embeddings and softmax weights are trained together by stochastic gradient descent in
numpy, on about ``per_language`` texts of each language, fewer if that would make more than ``SAMPLE_TEXTS`` in all. A temperature fitted on a part of them that the descent
doesn't see turns scores into probabilities; a prediction is accepted if its probability reaches the level at which the
calibration part has the asked precision.

The training sample is bounded whatever the number of languages (documented parameters, drawn by hash of the id); its
features are counted on the executors, so the driver holds at most ``SAMPLE_TEXTS`` sparse rows of ``BUCKETS`` places. Everything else
covers every row and whole texts, of any length.

Results for odd input: null text, empty text and text without a letter give ``und``, score 0, not accepted; with no
labelled row every row gives that; repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.frames import held_out, table, uniform
from caseloom.llm.hashing import LOWER, U, mix, text_chunks

UNKNOWN = "und"
BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
DIMENSIONS = 16
PER_LANGUAGE = 1500
SAMPLE_TEXTS = 12_000  # of all languages together
STEP_BYTES = 1 << 20


@dataclass
class LanguageModel:
    languages: list[str]
    embeddings: np.ndarray  # buckets x dimensions
    weights: np.ndarray  # dimensions x languages
    bias: np.ndarray
    temperature: float = 1.0
    accept_at: float = 0.0

    def probabilities(self, mean_embedding_scores: np.ndarray) -> np.ndarray:
        z = mean_embedding_scores / self.temperature
        z = np.exp(z - z.max(axis=-1, keepdims=True))
        return z / z.sum(axis=-1, keepdims=True)


def subword_counts(data: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket is hit by the byte n-grams of a text."""
    counts = np.zeros(buckets, np.int64)
    for lo in range(0, max(len(data), 1), STEP_BYTES):
        b = LOWER[data[lo:lo + STEP_BYTES + max(GRAMS) - 1]].astype(U)
        own = min(STEP_BYTES, len(data) - lo)  # grams that begin in this step
        gram = np.zeros(len(b), U)
        for n in range(1, max(GRAMS) + 1):
            gram = gram[:len(b) - n + 1] * U(257) + b[n - 1:] + U(1) if n <= len(b) else gram[:0]
            if n in GRAMS:
                hashed = mix(gram[:own] + U(n << 40)) & U(buckets - 1)
                counts += np.bincount(hashed.astype(np.int64), minlength=buckets)
    return counts


def _rows(batch_column):
    for lo, data, offsets in text_chunks(batch_column):
        for i in range(len(offsets) - 1):
            yield lo + i, data[offsets[i]:offsets[i + 1]]


def sample_features(docs: DataFrame, per_language: int = PER_LANGUAGE, buckets: int = BUCKETS, texts: int = SAMPLE_TEXTS) -> list:
    """(lang, bucket ids, relative frequencies) of about ``per_language`` labelled texts of each language, ``texts`` in all."""
    labelled = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # a row per language
    if not counts:
        return []
    per_language = max(1, min(per_language, texts // len(counts)))
    rate = F.element_at(F.create_map(*[F.lit(x) for k, v in counts.items() for x in (k, min(1.0, per_language / v))]),
                        F.col("lang"))
    drawn = labelled.where(F.col("text").rlike(r"\p{L}") & (uniform(F.col("doc_id"), seed="language") < rate))

    def features(batches):
        for b in batches:
            ids, values = [], []
            for _, data in _rows(b.column(1)):
                c = subword_counts(data, buckets)
                hit = np.flatnonzero(c)
                ids.append(hit.astype(np.int32))
                values.append((c[hit] / max(1, c.sum())).astype(np.float32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32())),
                                              pa.array(values, pa.list_(pa.float32()))], names=["lang", "ids", "values"])

    got = drawn.select("lang", "text").mapInArrow(features, "lang string, ids array<int>, values array<float>").toArrow()
    rows = zip(got["lang"].to_pylist(), (np.array(x.values) for x in got["ids"]), (np.array(x.values) for x in got["values"]),
               strict=True)
    return sorted(rows, key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))  # the same order in every run


def train(rows: list, buckets: int = BUCKETS, dimensions: int = DIMENSIONS, epochs: int = 12, rate: float = 40.0,
          precision: float = 0.99, seed: int = 11) -> LanguageModel | None:
    """Stochastic gradient descent over four fifths of the rows; temperature and acceptance on the rest."""
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted({r[0] for r in rows})
    truth = np.array([languages.index(r[0]) for r in rows])
    model = LanguageModel(languages, rng.normal(0, 0.1, (buckets, dimensions)), rng.normal(0, 0.1, (dimensions, len(languages))),
                          np.zeros(len(languages)))
    part = rng.permutation(len(rows))
    fit, check = part[len(rows) // 5:], part[:len(rows) // 5]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(fit):
            _, ids, values = rows[i]
            mean = values @ model.embeddings[ids]
            error = model.probabilities(mean @ model.weights + model.bias)
            error[truth[i]] -= 1
            back = model.weights @ error
            model.weights -= 0.01 * step * np.outer(mean, error)
            model.bias -= 0.0005 * step * error
            model.embeddings[ids] -= step * values[:, None] * back
    if len(check):
        scores = np.array([rows[i][2] @ model.embeddings[rows[i][1]] @ model.weights + model.bias for i in check])
        losses = {}
        for t in np.geomspace(0.1, 10, 41):
            model.temperature = float(t)
            own = model.probabilities(scores)[np.arange(len(check)), truth[check]]
            losses[float(t)] = -np.log(np.maximum(own, 1e-12)).mean()
        model.temperature = min(losses, key=losses.get)
        p = model.probabilities(scores)
        order = np.argsort(-p.max(axis=1), kind="stable")
        right = np.cumsum((p.argmax(axis=1) == truth[check])[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(right >= precision)
        model.accept_at = float(p.max(axis=1)[order[good[-1]]]) if len(good) else 1.0
    return model


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and accepted of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double, accepted boolean"
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select(F.col(id_col).alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(False).alias("accepted"))
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), letters.alias("letters"))
    buckets = len(model.embeddings)
    table_ = model.embeddings @ model.weights  # a score per bucket and language
    shared = docs.sparkSession.sparkContext.broadcast((table_, model))  # buckets x languages numbers, whatever the input

    def run(batches):
        scores, m = shared.value
        for b in batches:
            pred, score = [], []
            for _, data in _rows(b.column(1)):
                c = subword_counts(data, buckets)
                hit = np.flatnonzero(c)
                p = m.probabilities(c[hit] @ scores[hit] / max(1, c.sum()) + m.bias)
                best = int(p.argmax())
                pred.append(m.languages[best])
                score.append(float(p[best]))
            known = np.array(b.column(2).to_pylist(), bool)
            score = np.where(known, np.array(score, float), 0.0)
            pred = [x if ok else UNKNOWN for x, ok in zip(pred, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(pred, pa.string()), pa.array(score), pa.array(known & (score >= m.accept_at))],
                names=["doc_id", "lang_pred", "score", "accepted"])

    return src.mapInArrow(run, schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predict(docs, train(sample_features(docs)))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
