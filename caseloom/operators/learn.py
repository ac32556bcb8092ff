"""Learned replies (UDF-1): a log-linear classifier per reply field, trained on stored replies.

A ticket's evidence is the set of its message's and notes' tokens, each hashed with its origin into one of ``slots``
places (MD5, so any engine can reproduce it); long numbers are identifiers, not evidence. One weight per place
and allowed value scores every field at once. Training starts from smoothed log frequencies of the tokens under each
value and goes on by gradient rounds: a round reads one stored mini-batch of tickets (dealt by the ticket id's hash),
every task sums its rows' gradients in numpy, Spark adds the tasks' sums by place, and the driver takes an AdaGrad step.
A step also shrinks the weights, so a value that the text does not tell falls back to the most frequent one. What
reaches the driver is slots x values numbers, whatever the number of tickets. Weights are fixed-point integers, so a
score is an exact sum in any engine and order.

Root cause and next action are the most frequent stored ones of the predicted category, and the summary quotes the
sentence of the masked message that speaks most for it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.config import checkpoint_dir, discard, materialize
from caseloom.functions.pii import redact
from caseloom.operators.embed import tokens
from caseloom.schemas import ISSUE_CATEGORIES, SENTIMENTS, URGENCIES

HEADS: dict[str, list[str]] = {
    "issue_category": ISSUE_CATEGORIES, "sentiment": SENTIMENTS, "urgency": URGENCIES, "requires_human_followup": ["false", "true"]}
SCALE = 1 << 20  # fixed-point weights
SLOTS = 1 << 14
IDENTIFIER = r"^[0-9]{5,}$"
SENTENCE = r"[^.!?\n]+[.!?]*"


def _first_outputs() -> dict[str, int]:
    out, at = {}, 0
    for head, values in HEADS.items():
        out[head] = at
        at += len(values)
    return out


FIRST = _first_outputs()
OUTPUTS = sum(map(len, HEADS.values()))


def text_slots(text: Column, origin: str, slots: int = SLOTS) -> Column:
    """array<int>: the different places of a text's tokens; a null text has none."""
    kept = F.filter(tokens(F.coalesce(text, F.lit(""))), lambda t: ~t.rlike(IDENTIFIER))
    slot = F.transform(kept, lambda t: (F.conv(F.substring(F.md5(F.concat(F.lit(origin), t).cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int"))
    return F.array_distinct(slot)


def evidence(message: str = "customer_message", notes: str = "agent_notes", slots: int = SLOTS) -> Column:
    return F.array_distinct(F.concat(text_slots(F.col(message), "m:", slots), text_slots(F.col(notes), "n:", slots)))


def held_out(ticket_id: Column) -> Column:
    """A fifth of the tickets, by the MD5 of the id; a null id is held out."""
    return F.coalesce(F.conv(F.substring(F.md5(ticket_id.cast("string").cast("binary")), 1, 4), 16, 10).cast("int") % 5 == 0, F.lit(True))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of an Arrow list column, and each row's number of them."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)


def row_sums(weights: np.ndarray, slots: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bias (the last row of ``weights``) and the weights of each row's places, added up."""
    out = np.tile(weights[-1], (len(lengths), 1))
    some = lengths > 0
    if some.any():
        starts = np.concatenate(([0], np.cumsum(lengths)))[:-1][some]
        out[some] += np.add.reduceat(weights[slots], starts, axis=0)
    return out


def probabilities(logits: np.ndarray) -> np.ndarray:
    """Softmax of each head's outputs."""
    out = np.empty_like(logits)
    for head, values in HEADS.items():
        part = logits[:, FIRST[head]:FIRST[head] + len(values)]
        e = np.exp(part - part.max(axis=1, keepdims=True))
        out[:, FIRST[head]:FIRST[head] + len(values)] = e / e.sum(axis=1, keepdims=True)
    return out


def _summed(rows: DataFrame, slots: int, per_row: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Per place, the sum over rows (slots, labels) that hold it of ``per_row``; the last place is that of every row.

    ``per_row(slots, lengths, onehot)`` gives a row of numbers per row. Each task adds up its rows; Spark adds the tasks'
    sums by place.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((slots + 1, OUTPUTS))
        seen = 0
        for b in batches:
            flat, lengths = _flat(b.column("slots"))
            if not len(lengths):
                continue
            seen += len(lengths)
            labels, _ = _flat(b.column("labels"))
            onehot = np.zeros((len(lengths), OUTPUTS))
            onehot[np.repeat(np.arange(len(lengths)), len(HEADS)), labels] = 1
            values = per_row(flat, lengths, onehot)
            total[-1] += values.sum(axis=0)
            row = np.repeat(np.arange(len(lengths)), lengths)
            for o in range(OUTPUTS):
                total[:-1, o] += np.bincount(flat, values[row, o], slots)
        touched = np.flatnonzero(total.any(axis=1))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(touched.astype(np.int32)), *[pa.array(total[touched, o]) for o in range(OUTPUTS)]],
                                             names=["slot", *[f"s{o}" for o in range(OUTPUTS)]])

    sums = rows.select("slots", "labels").mapInArrow(add, "slot int, " + ", ".join(f"s{o} double" for o in range(OUTPUTS)))
    out = np.zeros((slots + 1, OUTPUTS))
    got = sums.groupBy("slot").agg(*[F.sum(f"s{o}").alias(f"s{o}") for o in range(OUTPUTS)]).toArrow()  # at most slots + 1 rows
    if got.num_rows:
        out[got.column("slot").to_numpy()] = np.column_stack([got.column(f"s{o}").to_numpy() for o in range(OUTPUTS)])
    return out


@dataclass
class ReplyModel:
    """Fixed-point weights (slots + 1 rows, the last the bias; a column per output) and each category's usual texts."""

    weights: np.ndarray
    usual: dict[str, tuple[str | None, str | None]]  # category: root cause, next action

    @property
    def slots(self) -> int:
        return len(self.weights) - 1

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(int(s), self.weights[s].tolist()) for s in range(len(self.weights))]
        spark.createDataFrame(rows, "slot int, weights array<bigint>").coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")
        spark.createDataFrame([(k, *v) for k, v in self.usual.items()], "issue_category string, root_cause string, action string").coalesce(
            1).write.mode("overwrite").parquet(f"{path}/usual")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ReplyModel:
        rows = sorted(spark.read.parquet(f"{path}/weights").collect())
        usual = {r[0]: (r[1], r[2]) for r in spark.read.parquet(f"{path}/usual").collect()}
        return ReplyModel(np.array([r[1] for r in rows], np.int64), usual)


def fixed_point(weights: np.ndarray) -> np.ndarray:
    return np.rint(weights * SCALE).astype(np.int64)


def log_frequencies(counts: np.ndarray) -> np.ndarray:
    """The starting weights from counts of (place, value): smoothed log shares, and the log priors as bias."""
    of_value = counts[-1]
    weights = np.log((counts + 1) / (of_value + 2))
    for head, values in HEADS.items():
        part = slice(FIRST[head], FIRST[head] + len(values))
        weights[-1, part] = np.log((of_value[part] + 1) / (of_value[part].sum() + len(values)))
    return weights


def training_rows(replies: DataFrame, slots: int = SLOTS, message: str = "customer_message", notes: str = "agent_notes") -> DataFrame:
    """(slots, labels, ticket_id) of the tickets whose stored reply is whole and allowed, none of them held out."""
    labels = [F.array_position(F.array(*map(F.lit, v)), F.col(h).cast("string")).cast("int") + (FIRST[h] - 1) for h, v in HEADS.items()]
    whole = F.col("enum_ok") & F.col("reply_error").isNull() & ~held_out(F.col("ticket_id"))
    return replies.where(whole).select(evidence(message, notes, slots).alias("slots"), F.array(*labels).alias("labels"), "ticket_id")


def usual_texts(replies: DataFrame) -> dict[str, tuple[str | None, str | None]]:
    """Per category (a row each) the most frequent root cause and next action of whole replies, the least text at ties."""
    whole = replies.where(F.col("enum_ok") & F.col("reply_error").isNull() & ~held_out(F.col("ticket_id")))
    found: dict[str, list[str | None]] = {c: [None, None] for c in ISSUE_CATEGORIES}
    for i, field in enumerate(("root_cause_hint", "next_best_action")):
        n = whole.where(F.col(field).isNotNull()).groupBy("issue_category", field).count()
        first = Window.partitionBy("issue_category").orderBy(F.col("count").desc(), field)
        for r in n.withColumn("rn", F.row_number().over(first)).where("rn = 1").collect():
            found[r["issue_category"]][i] = r[field]
    return {c: (v[0], v[1]) for c, v in found.items()}


def centred(weights: np.ndarray) -> np.ndarray:
    """The weights less their mean over a head's values, per place: the same probabilities, and 0 is no evidence."""
    out = weights.copy()
    for head, values in HEADS.items():
        part = slice(FIRST[head], FIRST[head] + len(values))
        out[:-1, part] -= out[:-1, part].mean(axis=1, keepdims=True)
    return out


def fit(replies: DataFrame, rounds: int = 24, batches: int = 4, rate: float = 0.3, shrink: float = 3e-3, slots: int = SLOTS,
        message: str = "customer_message", notes: str = "agent_notes") -> ReplyModel:
    """A model of the stored ``replies`` (tickets with the fields of ``parse_reply``); ``rounds`` 0 keeps the log frequencies.

    The mini-batches are written once to the shared checkpoint folder, a folder each; a round reads its own only.
    """
    spark = replies.sparkSession
    # read three times below, and a condition on its fields must not bring its parsing along
    replies = materialize(replies.select("ticket_id", message, notes, *HEADS, "reply_error", "enum_ok", "root_cause_hint", "next_best_action"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/reply-training-{uuid.uuid4().hex}"
    deal = F.pmod(F.xxhash64("ticket_id"), F.lit(max(1, batches))).cast("int")
    training_rows(replies, slots, message, notes).withColumn("batch", deal).write.partitionBy("batch").parquet(path)
    rows = spark.read.schema("slots array<int>, labels array<int>, ticket_id string, batch int").parquet(path)
    weights = log_frequencies(_summed(rows, slots, lambda flat, lengths, onehot: onehot))
    if rounds:
        weights = centred(weights)
    square = np.zeros_like(weights)
    sizes = {r["batch"]: r["count"] for r in rows.groupBy("batch").count().collect()}  # a row per batch
    for i in range(rounds if sizes else 0):
        batch = sorted(sizes)[i % len(sizes)]
        now = weights.copy()
        gradient = _summed(rows.where(F.col("batch") == batch), slots,
                           lambda flat, lengths, onehot: probabilities(row_sums(now, flat, lengths)) - onehot) / sizes[batch]
        gradient[:-1] += shrink * weights[:-1]
        square += gradient * gradient
        weights -= rate * gradient / np.sqrt(square + 1e-12)
    discard(spark, path)
    return ReplyModel(fixed_point(weights), usual_texts(replies))


def scores(model: ReplyModel, slots: Column) -> Column:
    """array<bigint>: the fixed-point score of every output, an Arrow batch at a time."""
    weights = model.weights

    @F.pandas_udf("array<bigint>")
    def score(lists: pd.Series) -> pd.Series:
        lengths = np.fromiter((0 if x is None else len(x) for x in lists), np.int64, len(lists))
        flat = np.concatenate([x for x in lists if x is not None and len(x)]).astype(np.int64) if lengths.sum() else np.zeros(0, np.int64)
        return pd.Series(list(row_sums(weights, flat, lengths)), index=lists.index, dtype=object)

    return score(slots)


def predictions(scored: Column) -> list[Column]:
    """Per head the value of the best score (the first listed at ties) and that score."""
    out = []
    for head, values in HEADS.items():
        part = F.slice(scored, FIRST[head] + 1, len(values))
        best = F.array_max(part)
        value = F.element_at(F.array(*map(F.lit, values)), F.array_position(part, best).cast("int"))
        out += [value.alias(head), best.alias(f"{head}_score")]
    return out


def predict(tickets: DataFrame, model: ReplyModel, message: str = "customer_message", notes: str = "agent_notes") -> DataFrame:
    """The tickets with a value and its fixed-point score per head."""
    keep = [c for c in tickets.columns if c not in HEADS and c.removesuffix("_score") not in HEADS]
    scored = tickets.select(*keep, scores(model, evidence(message, notes, model.slots)).alias("_scores"))
    return scored.select(*keep, *predictions(F.col("_scores")))


def _best_sentence(model: ReplyModel, sentences: Column, category: Column) -> Column:
    """Index of the sentence whose places speak most for the category against the average; the first at ties."""
    own = model.weights[:-1, :len(ISSUE_CATEGORIES)].astype(np.float64)
    lean = own - own.mean(axis=1, keepdims=True)

    @F.pandas_udf("int")
    def pick(lists: pd.Series, at: pd.Series) -> pd.Series:
        def one(rows, c) -> int | None:
            if rows is None or len(rows) == 0 or c is None or c != c:
                return None
            return int(np.argmax([lean[np.asarray(s, np.int64), int(c)].sum() if s is not None and len(s) else -np.inf for s in rows]))
        return pd.Series([one(r, c) for r, c in zip(lists, at)], index=lists.index, dtype="Int32")

    return pick(sentences, category)


def learned_reply(tickets: DataFrame, model: ReplyModel, message: str = "customer_message", notes: str = "agent_notes") -> DataFrame:
    """The eight reply fields, ``reply_error`` and ``enum_ok`` for every ticket, from a trained model."""
    guessed = predict(tickets, model, message, notes).drop(*[f"{h}_score" for h in HEADS])
    guessed = guessed.withColumn("_said", F.regexp_extract_all(redact(F.coalesce(F.col(message), F.lit(""))), F.lit(SENTENCE), F.lit(0)))
    per_sentence = F.transform("_said", lambda s: text_slots(s, "m:", model.slots))
    place = F.array_position(F.array(*map(F.lit, ISSUE_CATEGORIES)), F.col("issue_category")).cast("int") - 1
    quote = F.trim(F.get("_said", F.col("_pick")))
    named = F.lower(F.regexp_replace("issue_category", "_", " "))
    usual = [F.create_map(*[F.lit(x) for c, v in model.usual.items() for x in (c, v[i])]) for i in (0, 1)]
    return guessed.withColumn("_pick", _best_sentence(model, per_sentence, place)).withColumns({
        "requires_human_followup": F.col("requires_human_followup") == "true",
        "root_cause_hint": F.try_element_at(usual[0], F.col("issue_category")),
        "pii_redacted_message": F.col(message),
        "customer_summary": F.concat(F.initcap(named), F.lit(" on order "), F.coalesce(F.col("order_id"), F.lit("unknown")),
                                     F.when(F.length(quote) > 0, F.concat(F.lit(': "'), quote, F.lit('"'))).otherwise(F.lit("."))),
        "next_best_action": F.try_element_at(usual[1], F.col("issue_category")),
        "reply_error": F.lit(None).cast("string"),
        "enum_ok": F.lit(True),
    }).drop("_said", "_pick")


def accuracy(replies: DataFrame, guesses: dict[str, DataFrame]) -> DataFrame:
    """head, method, n, right: how often each method's value of a head equals the stored one, on held-out whole replies.

    ``guesses`` maps a method to tickets with ``ticket_id`` and the heads.
    """
    truth = replies.where(F.col("enum_ok") & F.col("reply_error").isNull() & held_out(F.col("ticket_id"))).select(
        "ticket_id", *[F.col(h).cast("string").alias(f"_{h}") for h in HEADS])
    out = []
    for method, guess in guesses.items():
        mine = guess.select("ticket_id", *[F.col(h).cast("string").alias(h) for h in HEADS])
        pairs = truth.join(mine, "ticket_id").select(F.explode(F.array(*[
            F.struct(F.lit(h).alias("head"), F.col(h).eqNullSafe(F.col(f"_{h}")).alias("right")) for h in HEADS])).alias("p")).select("p.*")
        out.append(pairs.groupBy("head").agg(F.count("*").alias("n"), F.count_if("right").alias("right")).select(
            "head", F.lit(method).alias("method"), "n", "right"))
    return out[0] if len(out) == 1 else _union(out)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
