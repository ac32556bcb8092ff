"""Ticket embeddings (OUT-7): composite text → vector, one row per ticket.

The hosted embedding model is replaced by a deterministic signed hashed
bag-of-words (the "hashing trick"): lower-case the text, take runs of Unicode
letters/digits as tokens, and for each token add ±1 to one of ``dim`` buckets.
Bucket and sign come from the token's MD5 (hex digits 1-4 → bucket, digit 5 →
sign), so any engine with md5 can reproduce the vector. Spark cuts the tokens
(one tokenizer, whatever the workers have installed); an Arrow-batched pandas
UDF adds them up. No shuffle, no grouping by key. A caller can pass
any other pandas UDF text → vector (a real model) as ``vector_fn``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions.text import embedding_text

TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def token_slot(token: str, dim: int) -> tuple[int, float]:
    h = hashlib.md5(token.encode("utf-8")).hexdigest()
    return int(h[:4], 16) % dim, (1.0 if int(h[4], 16) < 8 else -1.0)


class TokenSlots:
    """Bucket and sign of tokens, remembered across the batches of a task up to ``limit`` tokens."""

    def __init__(self, dim: int, limit: int = 1_000_000):
        self.dim, self.limit, self.known = dim, limit, {}

    def __call__(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.limit:
            self.known.clear()
        for t in distinct:
            if t not in self.known:
                self.known[t] = token_slot(t, self.dim)
        pairs = [self.known[t] for t in distinct]
        return np.array([s for s, _ in pairs], np.int64), np.array([w for _, w in pairs], np.float64)


def hashed_vectors(token_lists: pd.Series, slots: TokenSlots) -> pd.Series:
    """One Arrow batch: the distinct tokens are looked up, the rest is counting. A null list gives null."""
    lists = [x if x is not None else [] for x in token_lists]
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    out = np.zeros((len(lists), slots.dim))
    if lengths.sum():
        code, distinct = pd.factorize(np.concatenate([np.asarray(x, dtype=object) for x in lists if len(x)]))
        slot, sign = slots(distinct)
        row = np.repeat(np.arange(len(lists)), lengths)
        out = np.bincount(row * slots.dim + slot[code], weights=sign[code], minlength=out.size).reshape(out.shape)
    return pd.Series([v if x is not None else None for v, x in zip(out, token_lists, strict=True)],
                     index=token_lists.index, dtype=object)


def hashed_embedding(dim: int = 64):
    """UDF-2 default: a pandas UDF token list → array<double> of length ``dim``."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        slots = TokenSlots(dim)
        for batch in batches:
            yield hashed_vectors(batch, slots)

    return _embed


def embed(enrichment: DataFrame, dim: int = 64, vector_fn=None, text: Column | None = None) -> DataFrame:
    """OUT-7 / PRJ-14: ticket_id, order_id, issue_category, embedding."""
    text = text if text is not None else embedding_text()
    vector = vector_fn(text) if vector_fn else hashed_embedding(dim)(tokens(text))
    return enrichment.select("ticket_id", "order_id", "issue_category", vector.alias("embedding"))
