"""Toxicity by maximum-scoring segments: token log-odds, linear-time segment search, extreme-value calibration.

Each token's log-odds of occurring in toxic against clean texts has an informative Dirichlet prior, the token's share in
both classes together; a token scores if its log-odds are far enough above zero in standard errors. Every other token
costs a constant, so a text is a sequence of scores with negative mean, and all its maximal scoring segments come from
one left-to-right pass with a stack. By Karlin and Altschul's limit, the best segment of n random tokens follows an
extreme-value law in lambda * S - ln(K n); lambda solves E exp(lambda s) = 1 over clean tokens and K is fitted on clean texts. The
r best segments are aggregated by their sum statistic on that scale, for the r that speaks most, so several passages
weigh more than one. A logistic curve over it, fitted on the labels, gives the score; segments whose own tail
probability is below the level are the toxic passages.

The classifier is fitted on at most ``per_label`` labelled texts of each label (documented parameter, drawn by hash of the
id); all their tokens are counted. Every row's whole text is scored.

Results for odd input: null and empty texts have no token and get the score of a text without segments; with no
labelled row of one of the labels every score is 0; labels that are null or disagree for one id are left out or each
counted; repeated rows give repeated rows; texts of any length are passed once, token by token; extra columns are
ignored by ``score`` and kept by ``keep_clean``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.frames import cut, held_out, table, uniform

TOKEN = re.compile(r"\w+")
PER_LABEL = 8000
PRIOR = 0.1  # weight of the Dirichlet prior, as a share of all counts
STANDARD_ERRORS = 2.5
NO_SEGMENT = 12.0  # a text without segments stands as far below as the best of exp(12) tokens without gain
LEAST_TEXTS = 4  # toxic training texts a token must occur in to score


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


@dataclass
class ToxicityModel:
    odds: dict[str, float]
    cost: float = 0.1  # of a token that doesn't score
    rate: float = 1.0  # lambda of the extreme-value law
    log_k: float = 0.0
    slope: float = 1.0
    middle: float = 0.0
    level: float = 0.01  # tail probability below which a segment is a toxic passage

    def segments(self, words: list[str]) -> list[tuple[float, int, int]]:
        """All maximal scoring segments (score, first token, end token), by a pass with a stack of candidates.

        Costs between scoring tokens are added in one step, so the pass is linear in the scoring tokens.
        """
        odds, cost = self.odds, self.cost
        stack: list[tuple[float, float, int, int, int]] = []  # (sum before, sum after, first, end, link)
        gained = 0.0
        for seen, (i, word) in enumerate([(i, w) for i, w in enumerate(words) if w in odds]):
            left = gained - cost * (i - seen)  # sum of all scores left of token i
            gained += odds[word]
            right, first = gained - cost * (i - seen), i
            while True:
                k = len(stack) - 1
                while k >= 0 and stack[k][0] >= left:  # by links to the nearest candidate with a smaller left sum
                    k = stack[k][4]
                if k < 0 or stack[k][1] >= right:
                    stack.append((left, right, first, i + 1, k))
                    break
                left, first = stack[k][0], stack[k][2]  # extend it over everything since
                del stack[k:]
        return [(right - left, first, end) for left, right, first, end, _ in stack]

    def evidence(self, scores: list[float], n: int) -> float:
        """All segments of a text of n tokens on the extreme-value scale: -ln of the tail of the sum of the r best, e^-t
        t^(r-1) / (r! (r-1)!), at the r that makes it greatest, less ln 2 for each further r tried. One segment: its own
        scale."""
        if not scores:
            return -self.log_k - NO_SEGMENT
        shift, total, best = self.log_k + math.log(max(n, 1)), 0.0, -math.inf
        for r, s in enumerate(sorted(scores, reverse=True), 1):
            x = self.rate * s - shift
            if r > 1 and x <= 0:  # no further segment adds to the sum
                break
            total += x
            spread = math.lgamma(r + 1) + math.lgamma(r) - (r - 1) * math.log(total) if r > 1 and total > 0 else 0.0
            best = max(best, total + min(0.0, spread) - (r - 1) * math.log(2))
        return best

    def found(self, text: str) -> tuple[list[float], int]:
        """The scores of a text's segments, and its number of tokens."""
        words = tokens(text)
        return [s for s, _, _ in self.segments(words)], len(words)

    def tail(self, score: float, n: int) -> float:
        """Probability that a clean text of n tokens has a segment of this score."""
        return -math.expm1(-math.exp(min(50.0, self.log_k + math.log(max(n, 1)) - self.rate * score)))

    def score(self, scores: list[float], n: int) -> float:
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.slope * (self.evidence(scores, n) - self.middle)))))


def fit_odds(counts: list[tuple[str, int, int]], toxic_total: int, clean_total: int) -> dict[str, float]:
    """Log-odds of (token, toxic texts, clean texts) rows, for tokens clearly above zero. Totals add up over tokens.

    A token counts once a text: repeated lines would otherwise pass for evidence.
    """
    found = {}
    for word, a, b in counts:
        x, y = a + PRIOR * (a + b), b + PRIOR * (a + b)
        odds = math.log(x / ((1 + PRIOR) * toxic_total + PRIOR * clean_total - x)) - math.log(
            y / ((1 + PRIOR) * clean_total + PRIOR * toxic_total - y))
        z = odds / math.sqrt(1 / x + 1 / y)
        if a >= LEAST_TEXTS and z > STANDARD_ERRORS:
            found[word] = odds
    return found


def _log_k(maxima: list[tuple[float, int]], rate: float) -> float:
    """ln K by maximum likelihood over (best score, tokens) of clean texts with a segment."""
    shifted = [rate * s - math.log(n) for s, n in maxima if s > 0 and n > 0]
    return -math.log(np.mean(np.exp(-np.minimum(shifted, 50.0)))) if shifted else 0.0


def fit_law(model: ToxicityModel, rows: list[tuple[int, float, int]], hits: Counter, n_tokens: int) -> ToxicityModel:
    """Fit lambda and K on (label, best score, tokens); hits counts scoring tokens in clean texts."""
    def excess(rate: float) -> float:
        scoring = sum(c * math.exp(min(50.0, rate * model.odds[w])) for w, c in hits.items())
        return (scoring + (n_tokens - sum(hits.values())) * math.exp(-rate * model.cost)) / max(n_tokens, 1) - 1

    lo, hi = 1e-6, 50.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if excess(mid) < 0 else (lo, mid)
    model.rate = min(lo, 5.0)
    model.log_k = _log_k([(s, n) for y, s, n in rows if not y], model.rate)
    return model


def fit_curve(model: ToxicityModel, rows: list[tuple[int, float]]) -> ToxicityModel:
    """Fit the logistic curve on (label, evidence)."""
    x = np.array([v for _, v in rows])
    y = np.array([r[0] for r in rows], float)
    # a few Newton steps of logistic regression in (slope, offset), lightly held back
    a, b, scale = 0.0, 0.0, max(float(x.std()), 1e-9)
    u = (x - x.mean()) / scale
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * u + b, -40, 40)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * u).sum() + 1e-3 * a, (p - y).sum() + 1e-3 * b])
        h = np.array([[(w * u * u).sum() + 1e-3, (w * u).sum()], [(w * u).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
    model.slope = max(a, 1e-6) / scale
    model.middle = float(x.mean()) - b / model.slope if a > 1e-6 else float(x.max())
    return model


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> ToxicityModel | None:
    """Learn from labelled rows outside the held-out fold."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__toxic")).where(
        F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    counts = {r["__toxic"]: r["count"] for r in known.groupBy("__toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    rate = F.when(F.col("__toxic") == 1, min(1.0, per_label / counts[1])).otherwise(min(1.0, per_label / counts[0]))
    # about ``per_label`` ids of each label, whatever the number of labels: broadcast, so that no text is shuffled
    drawn = known.where(uniform(F.col("__id"), seed="toxicity") < rate)
    texts = cut(docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text")).join(F.broadcast(drawn), "__id"))

    def count(batches):
        for b in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen[y].update(set(tokens(text or "")))
            words = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(
                pa.array([seen[y][w] for w in words], pa.int64()) for y in (1, 0))], names=["word", "a", "b"])

    per_word = cut(texts.select("__text", "__toxic").mapInArrow(count, "word string, a long, b long")
                   .groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    totals = per_word.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    if not totals["a"] or not totals["b"]:
        return None
    # only tokens relatively more frequent in toxic texts can score, and each stands in some of the sample's toxic texts:
    # their number is bounded by the sample
    able = per_word.where((F.col("a") >= LEAST_TEXTS) & (F.col("a") * totals["b"] > F.col("b") * totals["a"]))
    model = ToxicityModel(fit_odds(sorted(tuple(r) for r in able.collect()), totals["a"], totals["b"]))
    if not model.odds:
        return model
    model.cost = max(0.05, min(model.odds.values()) / 4)

    def best(batches):
        for b in batches:
            out, hits, n_tokens = [], Counter(), 0
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = tokens(text or "")
                out.append((y, max((s for s, _, _ in model.segments(words)), default=0.0), len(words)))
                if not y:
                    n_tokens += len(words)
                    hits.update(w for w in words if w in model.odds)
            out += [(-1, w, c) for w, c in hits.items()] + [(-2, "", n_tokens)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] if r[0] >= 0 else 0.0 for r in out], pa.float64()),
                 pa.array([r[2] for r in out], pa.int64()), pa.array([r[1] if r[0] < 0 else "" for r in out], pa.string())],
                names=["kind", "best", "n", "word"])

    seen = texts.select("__text", "__toxic").mapInArrow(best, "kind int, best double, n long, word string").collect()
    hits: Counter = Counter()
    for r in seen:
        if r["kind"] == -1:
            hits[r["word"]] += r["n"]
    n_tokens = sum(r["n"] for r in seen if r["kind"] == -2)
    fit_law(model, sorted((r["kind"], r["best"], r["n"]) for r in seen if r["kind"] >= 0), hits, n_tokens)

    def weigh(batches):
        for b in batches:
            values = [model.evidence(*model.found(text or "")) for text in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(values, pa.float64())], names=["toxic", "evidence"])

    weighed = texts.select("__text", "__toxic").mapInArrow(weigh, "toxic int, evidence double").collect()  # the sample's rows
    return fit_curve(model, sorted(map(tuple, weighed)))


def score(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text",
          passages: bool = False) -> DataFrame:
    """doc_id, score, n_passages (and the toxic passages: first and end token, score) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # tokens of the sample

    def run(batches):
        m = shared.value
        for b in batches:
            scores, found = [], []
            for text in b.column(1).to_pylist():
                words = tokens(text)
                segs = m.segments(words) if m else []
                n = len(words)
                scores.append(m.score([s for s, _, _ in segs], n) if m and m.odds else 0.0)
                found.append([{"first": a, "end": e, "score": s} for s, a, e in segs if m.tail(s, n) < m.level])
            kind_ = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(map(len, found), pa.int64()),
                                              *([pa.array(found, kind_)] * passages)],
                                             names=["doc_id", "score", "n_passages"] + ["passages"] * passages)

    return src.mapInArrow(run, f"doc_id {kind}, score double, n_passages long"
                          + ", passages array<struct<first:bigint,end:bigint,score:double>>" * passages)


def keep_clean(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text") -> DataFrame:
    """The rows whose score stays below one half, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches):
        m = shared.value
        for b in batches:
            keep = []
            for text in b.column(place).to_pylist():
                keep.append(not (m and m.odds and m.score(*m.found(text or "")) >= 0.5))
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages")
