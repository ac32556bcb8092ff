"""Best-fit packing of tokenised documents into fixed-length sequences, in bulk-synchronous rounds.

Documents are cut only if longer than a sequence. Pieces are range-sorted by length, longest first, and open sequences
by gap. A round takes the pieces of one length: a successor sweep finds the smallest gap that holds them, ranks settle
which piece gets which of the equal gaps, the gaps shrink, and what finds no gap opens new sequences. Pieces of one
length are interchangeable, and so are gaps of one size; both sorted lists are therefore kept as run lengths. Spark
counts the lengths and ranks every piece within its length; the sweep sees runs only, at most one per length and gap
size and place, whatever the number of documents; Spark then joins every piece to the run its rank falls in.

Results for odd input: a null text counts as empty; an empty text is its end token alone; a null document id is kept as
null; repeated rows are packed each; ties between equal lengths are settled by id, piece and checksum; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.config import checkpoint_dir
from caseloom.llm.frames import cut, table
from caseloom.llm.token_counts import byte_alphabet

SEQUENCE_TOKENS = 4096
END_TOKEN = 1
MEMO_ENTRIES = 800_000  # words whose ids a worker keeps; beyond it the memo starts anew
CHARS_AT_ONCE = 4_000_000  # of the texts that are parted into words at a time; one longer text is taken alone
MEMO_CHARS = 48
RANK_BLOCK = 1 << 16  # ranks are joined to runs in blocks, so no join key holds more pieces than this
RUNS_AT_ONCE = 1 << 20  # runs sent from the driver at a time


def _below(text: str) -> bool:
    """Whether lower case works alike on every character: none is U+0130 or beyond."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return max(text) < "\u0130"
    return True


def folded(text: str, special: re.Pattern | None = None) -> str:
    """The text in lower case where that is what the tokenizer does first anyway, and every character alike; else unchanged.

    The tokenizer parts its special strings off before that: a text in which folding would make another one, stays as it is."""
    if not (text.isascii() or _below(text)):
        return text
    low = text.lower()
    return text if special and low != text and special.findall(low) != special.findall(text) else low


class WordEncoder:
    """Ids of whole texts, put together from the ids of their blank-separated words.

    The tokenizer drops white space and never joins what white space parts, so the words of a text can be encoded
    once each. Arrow parts the texts of a batch into words and numbers the different ones; only these are looked up, and
    the ids of all words are then taken from theirs by number. New words of a batch are encoded in one call and parted
    again by their offsets.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.memo: dict[str, bytes] = {"": b""}
        self.marks = {mark: self.ids(mark) for mark in ",."}
        self.alphabet = byte_alphabet()
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(added)) if added else None

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def plain(self, word: str) -> bytes | None:
        """Ids of a lower-case word of letters, with or without a comma or full stop, straight from the merges: it is one
        part (and the mark another) for the tokenizer, and the steps before change nothing. None for other words."""
        stem, mark = (word[:-1], word[-1]) if word[-1] in self.marks and len(word) > 1 else (word, "")
        plain = stem.isascii()
        if not stem.isalpha() or not (plain or _below(stem)) or stem != stem.lower():
            return None
        ids = self.memo.get(stem) if mark else None
        if ids is None:
            text = stem if plain else "".join(map(self.alphabet.__getitem__, stem.encode()))
            tokens = self.model.tokenize(text)
            ids = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
            if mark:
                self.memo[stem] = ids
        return ids + self.marks[mark] if mark else ids

    def learn(self, words: list[str]) -> None:
        rest = []
        for word in words:
            ids = self.plain(word) if word else b""
            if ids is None:
                rest.append(word)
            else:
                self.memo[word] = ids
        for lo in range(0, len(rest), 4096):
            part = rest[lo:lo + 4096]
            got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(got.ids, "<u4").tobytes()
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            starts = np.fromiter((a for a, _ in got.offsets), np.int64, len(got.ids))
            bounds = (np.searchsorted(starts, ends, "left") * 4).tolist()
            at = 0
            for word, end in zip(part, bounds, strict=True):
                self.memo[word] = ids[at:end]
                at = end

    def known(self, words: list[str]) -> list[bytes]:
        """The ids of different words, each looked up once; a word too long for the memo is encoded each time."""
        ids = list(map(self.memo.get, words))
        missing = [i for i, x in enumerate(ids) if x is None]
        new = [words[i] for i in missing if len(words[i]) <= MEMO_CHARS]
        if len(self.memo) + len(new) > MEMO_ENTRIES:  # start anew with the words in use
            self.memo = {"": b""} | {w: x for w, x in zip(words, ids) if x is not None}
        self.learn(new)
        for i in missing:
            ids[i] = self.memo[words[i]] if len(words[i]) <= MEMO_CHARS else self.ids(words[i])
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        out, some, chars = [], [], 0
        for text in texts:
            if some and chars + len(text) > CHARS_AT_ONCE:
                out += self._encode(some)
                some, chars = [], 0
            some.append(folded(text, self.special).replace("\n", " "))
            chars += len(text)
        return out + self._encode(some) if some else out

    def _encode(self, texts: list[str]) -> list[bytes]:
        parted = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        words = parted.flatten().dictionary_encode()
        ids = self.known(words.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        code = words.indices.to_numpy()
        size = sizes[code]
        end = np.concatenate([[0], np.cumsum(size)])
        tokens = pool[np.arange(end[-1]) + np.repeat((np.cumsum(sizes) - sizes)[code] - end[:-1], size)]
        bounds = end[parted.offsets.to_numpy()]
        return [tokens[lo:hi].tobytes() for lo, hi in zip(bounds[:-1], bounds[1:])]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, path: str, capacity: int = SEQUENCE_TOKENS, end_token: int = END_TOKEN,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids as little-endian bytes) of every piece."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size, end = 4 * capacity, np.array([end_token], "<u4").tobytes()

    def pieces(batches):
        enc = encoder(path)
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                rows = []
                for i, ids in enumerate(enc.encode(part.column(1).to_pylist())):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), size)):
                        piece = ids[at:at + size]
                        rows.append((i, k, at // 4, len(piece) // 4, zlib.crc32(piece), piece if with_ids else None))
                row, piece, start, length, crc, raw = zip(*rows, strict=True)
                arrays = [part.column(0).take(pa.array(row)), *(pa.array(x, t) for x, t in (
                    (piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (crc, pa.int64())))]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(raw, pa.binary())] * with_ids, names=[
                    "doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return src.mapInArrow(pieces, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
                          + ", ids binary" * with_ids)


def best_fit_runs(lengths: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """The rounds over run lengths: (length, first rank, end rank, first sequence, offset) of each match.

    ``lengths`` counts the pieces of each length (at most ``capacity`` entries). Of equal gaps, the sequences opened
    first are filled first.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # gap: [first sequence, end)
    gaps: list[int] = []  # sizes of open gaps, sorted
    opened, matches = 0, []

    def shrink(gap: int, lo: int, hi: int) -> None:
        if gap:
            if gap not in runs:
                insort(gaps, gap)
                runs[gap] = []
            if runs[gap] and runs[gap][-1][1] == lo:
                runs[gap][-1] = (runs[gap][-1][0], hi)
            else:
                runs[gap].append((lo, hi))

    for length in sorted(lengths, reverse=True):
        rank, count = 0, lengths[length]
        while rank < count:
            at = bisect_left(gaps, length)
            if at == len(gaps):  # none holds it: each new sequence takes as many as it can, in turn
                fresh = -(-(count - rank) // (capacity // length))
                shrink(capacity, opened, opened + fresh)
                opened += fresh
                continue
            gap = gaps.pop(at)
            todo = runs.pop(gap)
            while todo and rank < count:
                lo, hi = todo.pop(0)
                took = min(hi - lo, count - rank)
                matches.append((length, rank, rank + took, lo, capacity - gap))
                rank += took
                shrink(gap - length, lo, lo + took)
                if took < hi - lo:
                    todo.insert(0, (lo + took, hi))
            if todo:
                insort(gaps, gap)
                runs[gap] = todo
    return matches


def _table(spark: SparkSession, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """The rows as a table of longs; more than ``RUNS_AT_ONCE`` go to the checkpoint folder in parts."""
    if len(rows) <= RUNS_AT_ONCE:
        return spark.createDataFrame(pa.table({k: pa.array([x[i] for x in rows], pa.int64()) for i, k in enumerate(names)}))
    path = f"{checkpoint_dir(spark).rstrip('/')}/packing-runs-{uuid.uuid4().hex}"
    for lo in range(0, len(rows), RUNS_AT_ONCE):
        _table(spark, rows[lo:lo + RUNS_AT_ONCE], names).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def pack(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, keys: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add sequence_id and offset to rows that have ``length`` (1 to ``capacity``) and the ``keys`` that order ties."""
    spark = pieces.sparkSession
    pieces = cut(pieces)
    lengths = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    if lengths and not 1 <= min(lengths) <= max(lengths) <= capacity:
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    matches = best_fit_runs(lengths, capacity)
    placed = _table(spark, matches, ("length", "__lo", "__hi", "__sequence", "offset")).withColumn("__block", F.explode(F.expr(
        f"sequence(__lo div {RANK_BLOCK}, (__hi - 1) div {RANK_BLOCK})")))

    # rank within a length: the rows of a length are dealt to salts, ranked there, and moved up by the salts before
    salt = F.pmod(F.xxhash64(*keys, "ids_crc32"), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    salted = pieces.withColumn("__salt", salt)
    order = [*keys, *[c for c in pieces.columns if c not in keys]]
    local = F.expr(f"row_number() over (partition by __salt, length order by {', '.join(f'`{c}`' for c in order)}) - 1")
    before = salted.groupBy("length", "__salt").agg(F.count("*").alias("__n")).select(
        "length", "__salt", F.expr("sum(__n) over (partition by length order by __salt) - __n").alias("__before"))
    rank = salted.withColumn("__local", local).join(before, ["length", "__salt"]).select(
        *pieces.columns, (F.col("__before") + F.col("__local")).alias("__rank"))
    rank = rank.withColumn("__block", F.expr(f"__rank div {RANK_BLOCK}"))
    fits = (F.col("__rank") >= F.col("__lo")) & (F.col("__rank") < F.col("__hi"))
    return rank.join(placed, ["length", "__block"]).where(fits).select(
        *pieces.columns, (F.col("__sequence") + F.col("__rank") - F.col("__lo")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every row."""
    return pack(token_pieces(docs, path, capacity), capacity)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
