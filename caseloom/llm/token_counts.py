"""Token counts of byte-level BPE by prefix dynamic programming.

A greedy-merge encoding has optimal substructure from the left: the encoding of a prefix is the encoding of a
shorter prefix and one last token, and two neighbouring tokens are valid exactly if encoding their joined text gives
the two back. So one pass over a pre-token finds the last token and the exact count for *every* prefix; the count at
any cut, the longest prefix within a budget, and the total are look-ups.

A text is a list of segments (white space and the word after it). Pre-tokens never span two segments, so counts add
up over them. Tables of short segments are kept in a bounded memo per worker.

Results for odd input: null text counts as empty (0 tokens); repeated rows give repeated rows; a string equal to the
tokenizer's added special token is that one token, as the library's default has it; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.frames import table

WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"  # Unicode White_Space
SEGMENT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
MEMO_ENTRIES = 600_000  # segments (and token pairs) a worker keeps; beyond it the memo starts anew
MEMO_CHARS = 64


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE files."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = (chr(256 + i) for i in range(256))
    return [chr(b) if b in set(kept) else next(rest) for b in range(256)]


class PrefixCounter:
    """Exact token counts at every prefix, for one tokenizer file of kind byte-level BPE."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"] or model["ignore_merges"]:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        self.ids = model["vocab"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): r for r, m in enumerate(model["merges"])}
        self.longest = max(map(len, self.ids))
        self.alphabet = byte_alphabet()
        self.pretoken = regex.compile(public_tokenizers.PATTERN)
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(special)) if special else None
        # by token id: the rank of the merge that made it (-1: a single byte) and the two parts; by pair of ids: its rank
        size = max(self.ids.values()) + 1
        self.made, self.parts, self.joins = [-1] * size, [(-1, -1)] * size, {}
        for (a, b), r in self.ranks.items():
            left, right, both = self.ids[a], self.ids[b], self.ids[a + b]
            self.made[both], self.parts[both], self.joins[left << 20 | right] = r, (left, right), r
        self.alone: dict[str, bool] = {}  # at most a token each
        self.pairs: dict[int, bool] = {}
        self.states: dict[str, tuple[int, int]] = {}
        self.totals: dict[str, int] = {}

    def merge(self, symbols: list[str]) -> list[str]:
        """Greedy merges, lowest rank first, leftmost among equals."""
        symbols = list(symbols)
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == 1 << 60:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def begins(self, token: str) -> bool:
        """Whether a token's own text is encoded as that token."""
        known = self.alone.get(token)
        if known is None:
            known = self.alone[token] = self.merge(list(token)) == [token]
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether token ``right`` may follow ``left`` in an encoding.

        Both are taken apart in the reverse order of their merges. If at some moment the two parts that touch could have
        merged before the part just taken apart was made, the greedy encoder would have joined them instead.
        """
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is not None:
            return known
        if len(self.pairs) >= MEMO_ENTRIES:
            self.pairs.clear()
        joins, made, parts = self.joins, self.made, self.parts
        a, b, before, known = left, right, 1 << 60, True
        while True:
            rank = joins.get(a << 20 | b)
            if rank is not None and rank < before:
                known = False
                break
            # take apart what was merged last; of one rank, the encoder merges the left one first
            if made[a] < 0 and made[b] < 0:
                break
            if made[a] > made[b]:
                before, a = made[a], parts[a][1]
            else:
                before, b = made[b] + 1, parts[b][0]
        self.pairs[key] = known
        return known

    def state(self, s: str) -> tuple[int, int]:
        """(last token, count) of the pre-token prefix ``s`` (in the byte alphabet), from the top down.

        Only the prefixes that a token could be added to are looked at; their states are stored, and pre-tokens that
        begin alike share them.
        """
        states, ids = self.states, self.ids
        known = states.get(s)
        if known is not None:
            return known
        n = len(s)
        for j in range(max(0, n - self.longest), n):
            token = ids.get(s[j:])
            if token is None:
                continue
            if j:
                left, count = states.get(s[:j]) or self.state(s[:j])
                if not self.fits(left, token):
                    continue
            elif self.begins(s):
                count = 0
            else:
                continue
            if len(states) >= MEMO_ENTRIES:
                states.clear()
            states[s] = known = token, count + 1
            return known
        raise ValueError(f"no encoding of {s!r}")

    def pretoken_counts(self, pretoken: str) -> list[int]:
        """counts[i]: tokens of the first i bytes of a pre-token, for every i."""
        return self.run_counts(pretoken.encode())

    def pretoken_total(self, pretoken: str) -> int:
        data = pretoken.encode()
        if len(data) <= MEMO_CHARS:
            return self.state("".join(map(self.alphabet.__getitem__, data)))[1]
        return self.run_counts(data)[-1]

    def run_counts(self, data: bytes) -> list[int]:
        """The same table for a long pre-token, in lists instead of the memo."""
        s = "".join(map(self.alphabet.__getitem__, data))
        last, counts = [-1], [0]
        for i in range(1, len(s) + 1):
            for j in range(max(0, i - self.longest), i):
                token = self.ids.get(s[j:i])
                if token is not None and (self.fits(last[j], token) if j else self.begins(s[:i])):
                    last.append(token)
                    counts.append(counts[j] + 1)
                    break
        return counts

    def pretokens(self, segment: str) -> list[str]:
        """The pre-tokens of a segment; a blank and plain letters, with a comma or full stop, need no pattern."""
        word = segment[1:-1]
        if segment[0] == " " and word.isalpha() and max(word) < "\u0250":
            end = segment[-1]
            if end in ".,":
                return [segment[:-1], end]
            if end.isalpha() and end < "\u0250":
                return [segment]
        return self.pretoken.findall(segment)

    def segment_total(self, segment: str) -> int:
        total = self.totals.get(segment)
        if total is None:
            total = sum(map(self.pretoken_total, self.pretokens(segment)))
            if len(segment) <= MEMO_CHARS:
                if len(self.totals) >= MEMO_ENTRIES:
                    self.totals.clear()
                self.totals[segment] = total
        return total

    def segments(self, text: str) -> Iterator[tuple[str, int]]:
        """(segment, tokens) in order; an added special token is a segment of one token."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            for s in SEGMENT.findall(text[at:m.start()]):
                yield s, self.segment_total(s)
            yield m[0], 1
            at = m.end()
        for s in SEGMENT.findall(text[at:] if at else text):
            yield s, self.segment_total(s)

    def total(self, text: str) -> int:
        if self.special and self.special.search(text):
            return sum(n for _, n in self.segments(text))
        known = self.totals
        parts = SEGMENT.findall(text)
        try:
            return sum(map(known.__getitem__, parts))
        except KeyError:
            return sum(map(self.segment_total, parts))

    def prefix_table(self, text: str) -> tuple[list[int], list[int]]:
        """Characters and tokens up to the end of each segment, from (0, 0)."""
        ends, counts = [0], [0]
        for s, n in self.segments(text):
            ends.append(ends[-1] + len(s))
            counts.append(counts[-1] + n)
        return ends, counts

    def inside(self, segment: str, chars: int) -> int:
        """Tokens of the first ``chars`` characters of a segment, from the table of its last pre-token."""
        parts = self.pretoken.findall(segment[:chars])
        return sum(self.segment_total(p) for p in parts[:-1]) + (self.pretoken_total(parts[-1]) if parts else 0)

    def count_at(self, text: str, cut: int, table: tuple[list[int], list[int]] | None = None) -> int:
        """Exact tokens of text[:cut], from the stored prefix table."""
        from bisect import bisect_right

        ends, counts = table or self.prefix_table(text)
        cut = max(0, min(cut, len(text)))
        k = bisect_right(ends, cut) - 1
        return counts[k] + self.inside(text[ends[k]:cut], cut - ends[k])

    def longest_within(self, text: str, budget: int) -> int:
        """Where to cut the text so that it holds at most ``budget`` tokens: the last whole segment that fits, and of the
        next one as many characters as the tables of its pre-tokens allow."""
        end = count = 0
        for s, n in self.segments(text):
            if count + n <= budget:
                end, count = end + len(s), count + n
                continue
            if self.special and self.special.fullmatch(s):
                return end
            room, fits, at = budget - count, [], 0
            for p in self.pretoken.findall(s):
                counts, size = self.run_counts(p.encode()), 0
                for j, c in enumerate(p, 1):
                    size += len(c.encode())
                    if counts[size] <= room:
                        fits.append(at + j)
                room, at = room - counts[-1], at + len(p)
            # a cut inside white space or before an ending may be split otherwise: the count there decides
            return end + next((j for j in reversed(fits) if self.inside(s, j) <= budget - count), 0)
        return end


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per worker process and tokenizer file."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, limit_chars (where to cut for at most ``limit`` tokens) for every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def count(batches):
        c = counter(path)
        for b in batches:
            texts = b.column(1).to_pylist()
            totals = [c.total(t) for t in texts]
            cuts = [len(t) if n <= limit else c.longest_within(t, limit) for t, n in zip(texts, totals, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(totals, pa.int64()),
                 pa.array(cuts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens", "limit_chars"])

    out = src.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, limit_chars long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "limit_chars")


def prefix_tables(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the stored table: ``ends`` (characters) and ``counts`` (tokens) at every segment end."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def tabulate(batches):
        c = counter(path)
        for b in batches:
            both = [c.prefix_table(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in both], pa.list_(pa.int64())),
                                              pa.array([y for _, y in both], pa.list_(pa.int64()))],
                                             names=["doc_id", "ends", "counts"])

    return src.mapInArrow(tabulate, f"doc_id {kind}, ends array<bigint>, counts array<bigint>")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
