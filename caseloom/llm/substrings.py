"""Exact substring dedup on words, by minimiser-bucketed compaction of the de Bruijn graph.

The windows of ``window`` words are the edges of a de Bruijn graph. Consecutive windows of a text that share their
minimiser (the least hashed ``gram``-word gram inside, rightmost of equals) form one path piece, which is dealt whole to
the bucket of that minimiser. Equal windows have equal minimisers at equal places, so all copies of an edge meet in one
bucket. There each edge keeps its first source coordinate, and the later copies of a piece are compacted to runs. Runs
are glued along their source coordinates when they are joined back to the documents, so a repeated passage of any length
comes back as one span.

A bucket may hold any share of all windows (a line that very many texts quote with different surroundings). Windows are
first counted in bins of buckets, each task adding up its own; the pieces of a bin with too many are cut into their windows,
which are dealt to as many parts as it needs by the window's hash. Equal windows still meet, but of those that meet in
one batch already only the first is sent there; the others are known to be copies and are spread over all tasks.

An edge is known by its minimiser's 64-bit hash, its place relative to it, and a whole independent 64-bit hash of all its
words (10 million distinct windows in one bucket make about 3 false matches in a million runs); coordinates keep a window
from counting as its own copy.

Results for odd input: null and empty texts have no words and nothing is removed (the digest is that of the empty
text); texts shorter than a window are kept whole; null ids come first and repeated ids follow each other in the order
of their texts, so a repeated row loses the windows it repeats; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.frames import coordinates, table
from caseloom.llm.hashing import BASE, U, gram_starts, mix, range_hash, slide_min, text_chunks, word_hashes, words_of

WINDOW = 20
GRAM = 6
EDGE_BYTES = 8
BUCKET_WINDOWS = 1 << 18  # windows of one bucket that one task may take
BIN_BITS = (14, 20)  # least and most bins that buckets are counted in: one for 16 texts


def path_pieces(h0: np.ndarray, h1: np.ndarray, first: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """For the word hashes of some texts: (row, minimiser hash, first window, windows) of each piece, its windows'
    hashes in order, and each window's place relative to the minimiser."""
    width = window - gram + 1
    rows = np.arange(len(first) - 1)
    starts, bounds = gram_starts(first, gram)
    grams = range_hash(h0, starts, starts + gram)
    wins, win_bounds = gram_starts(first, window)
    edges = range_hash(h1, wins, wins + window)
    picked = []
    low = U((1 << 32) - 1)
    for i in rows[np.diff(win_bounds) > 0]:
        g = grams[bounds[i]:bounds[i + 1]]
        keys = (g & ~low) | (low - np.arange(len(g), dtype=U))  # the least hash, rightmost of equals
        picked.append(bounds[i] + (low - (slide_min(keys, width) & low)).astype(np.int64))
    if not picked:
        return None
    picked = np.concatenate(picked)  # index of each window's minimiser
    new = np.concatenate(([True], picked[1:] != picked[:-1]))
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(picked)))
    row = np.searchsorted(win_bounds, head, "right") - 1
    place = starts[picked] - wins
    return row, grams[picked[head]], wins[head] - first[row], count, edges, place


def _bin_sizes(batches, window: int, gram: int, bins: int):
    """(bin, windows) of a task's texts."""
    sizes = np.zeros(bins, np.int64)
    for b in batches:
        for _, data, offsets in text_chunks(b.column(0)):
            s, e, first = words_of(data, offsets)
            h0 = word_hashes(data, s, e, 0)
            got = path_pieces(h0, h0, first, window, gram)
            if got is not None:
                sizes += np.bincount((got[1] & U(bins - 1)).astype(np.int64), got[3], bins).astype(np.int64)
    some = np.flatnonzero(sizes)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(sizes[some])], names=["bin", "windows"])


def parts_of_bins(texts: DataFrame, window: int, gram: int, bucket_windows: int) -> np.ndarray:
    """For every bin of buckets the parts it is cut into; 1 for most. Bins of up to four times the mean stay whole."""
    bits = (max(texts.count(), 16) // 16).bit_length()
    bins = 1 << min(max(bits, BIN_BITS[0]), BIN_BITS[1])
    sizes = texts.mapInArrow(lambda b: _bin_sizes(b, window, gram, bins), "bin int, windows long").groupBy("bin").agg(
        F.sum("windows").alias("n")).toArrow()  # at most a row per bin
    n = np.zeros(bins, np.int64)
    n[sizes.column("bin").to_numpy()] = sizes.column("n").to_numpy()
    return np.where(n > max(bucket_windows, 4 * int(n.sum()) // bins), -(-n // bucket_windows), 1)


def _pieces(batches, window: int, gram: int, parts: np.ndarray):
    """Rows (bucket, at, piece): a piece is its first window's place in its text (4 bytes) and its windows' hashes. A copy of
    a window sent from here has no hash, and any bucket."""
    cut_some = bool((parts > 1).any())
    for b in batches:
        ats = np.asarray(b.column(0))
        for lo, data, offsets in text_chunks(b.column(1)):
            s, e, first = words_of(data, offsets)
            got = path_pieces(word_hashes(data, s, e, 0), word_hashes(data, s, e, 1), first, window, gram)
            if got is None:
                continue
            row, minimiser, start, count, edges, place = got
            edges = mix(edges + place.astype(U)).astype("<u8")
            if cut_some:
                of_bin = parts[(minimiser & U(len(parts) - 1)).astype(np.int64)].astype(U)
                many = of_bin > 1
                if many.any():  # one row a window
                    each = np.where(many, count, 1)
                    piece = np.repeat(np.arange(len(count)), each)
                    step = np.arange(len(piece)) - (np.cumsum(each) - each)[piece]
                    begin = (np.cumsum(count) - count)[piece] + step
                    part = edges[begin].astype(U) % of_bin[piece] + U(1)
                    minimiser = np.where(many[piece], mix(minimiser[piece] + part * U(BASE)), minimiser[piece])
                    row, start, count = row[piece], start[piece] + step, np.where(many[piece], 1, count[piece])
                    one = np.flatnonzero(many[piece])  # of equal windows the first, by coordinate
                    key = mix(edges[begin[one]].astype(U) ^ mix(minimiser[one]))
                    order = np.lexsort((start[one], ats[lo + row[one]], key))
                    copy = one[order[1:]][key[order[1:]] == key[order[:-1]]]
                    keep = np.ones(len(edges), bool)
                    keep[begin[copy]] = False
                    edges = edges[keep]
                    count[copy] = 0
                    minimiser[copy] = mix(ats[lo + row[copy]].astype(np.int64).view(U) + start[copy].astype(U))
            ends = np.append(0, np.cumsum(1 + 2 * count))  # in words of four bytes
            words = np.empty(ends[-1], "<u4")
            rest = np.ones(ends[-1], bool)
            rest[ends[:-1]] = False
            words[ends[:-1]] = start.astype("<u4").byteswap()  # so that pieces sort by it
            words[rest] = edges.view("<u4")
            raw = pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(words)])
            yield pa.RecordBatch.from_arrays([pa.array(minimiser.view(np.int64)), pa.array(ats[lo + row]), raw], names=["bucket", "at", "piece"])


def _later_copies(batches):
    """Runs (at, start, windows) of windows whose edge has an earlier coordinate. Rows come sorted by bucket, at, piece.

    Only the edges of the bucket that a batch ends in are carried to the next."""
    carried = None  # (bucket, sorted keys, at, start)
    for b in batches:
        if not b.num_rows:
            continue
        bucket, at = (np.asarray(b.column(i)) for i in range(2))
        col = b.column(2)
        ends = np.frombuffer(col.buffers()[1], np.int32, b.num_rows + 1, col.offset * 4).astype(np.int64)
        words = np.frombuffer(col.buffers()[2], np.uint8)[ends[0]:ends[-1]].view("<u4")
        heads = (ends[:-1] - ends[0]) // 4
        start = words[heads].byteswap().astype(np.int32)
        rest = np.ones(len(words), bool)
        rest[heads] = False
        edges = words[rest].view("<u8").astype(U)
        count = np.diff(ends) // EDGE_BYTES  # the place's four bytes don't make one
        known_copy = np.flatnonzero(count == 0)
        if len(known_copy):
            yield pa.RecordBatch.from_arrays([pa.array(at[known_copy]), pa.array(start[known_copy]), pa.array(np.ones(len(known_copy), np.int32))],
                                             names=["at", "start", "windows"])
        if len(known_copy) == b.num_rows:
            continue
        piece = np.repeat(np.arange(b.num_rows), count)
        key = mix(edges ^ mix(bucket.view(U))[piece])  # one to one inside a bucket
        w_at = at[piece]
        w_start = start[piece] + np.arange(len(piece)) - (np.cumsum(count) - count)[piece]
        uniq, index, inverse = np.unique(key, return_index=True, return_inverse=True)
        f_at, f_start = w_at[index], w_start[index]
        if carried is not None and len(carried[1]):
            place = np.minimum(np.searchsorted(carried[1], uniq), len(carried[1]) - 1)
            known = carried[1][place] == uniq
            f_at[known], f_start[known] = carried[2][place[known]], carried[3][place[known]]
        later = (w_at != f_at[inverse]) | (w_start != f_start[inverse])
        last = bucket[-1]
        mine = bucket[piece[index]] == last
        if carried is not None and carried[0] == last:
            keys, ats, starts = (np.concatenate(x) for x in ((carried[1], uniq[mine]), (carried[2], f_at[mine]), (carried[3], f_start[mine])))
            keys, keep = np.unique(keys, return_index=True)  # the carried one comes first
            carried = (last, keys, ats[keep], starts[keep])
        else:
            carried = (last, uniq[mine], f_at[mine], f_start[mine])
        hit = np.flatnonzero(later)
        if len(hit):
            new = np.concatenate(([True], (hit[1:] != hit[:-1] + 1) | (piece[hit[1:]] != piece[hit[:-1]])))
            head = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(w_at[hit[head]]), pa.array(w_start[hit[head]].astype(np.int32)),
                 pa.array(np.diff(np.append(head, len(hit))).astype(np.int32))], names=["at", "start", "windows"])


def repeated_runs(rows: DataFrame, window: int = WINDOW, gram: int = GRAM, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Runs (at, start, windows) of word windows that also begin earlier, for rows (at, text)."""
    parts = parts_of_bins(rows.select("text"), window, gram, bucket_windows)
    pieces = rows.select("at", "text").mapInArrow(lambda b: _pieces(b, window, gram, parts), "bucket long, at long, piece binary")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(n, "bucket").sortWithinPartitions("bucket", "at", "piece").mapInArrow(
        _later_copies, "at long, start int, windows int")


def covered_words(n: int, runs: np.ndarray, window: int) -> np.ndarray:
    """Which of n words the runs (start, windows) cover; runs that meet or overlap are glued."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0], 1)
    np.add.at(change, np.minimum(runs[:, 0] + runs[:, 1] + window - 1, n), -1)
    return np.cumsum(change)[:n] > 0


def dedup_substrings(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                     with_text: bool = False, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_spans (and kept_text) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = coordinates(docs, id_col, text_col)
    runs = repeated_runs(rows, window, bucket_windows=bucket_windows).groupBy("at").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    joined = rows.join(runs.hint("shuffle_hash"), "at", "left").select("doc_id", "text", "runs.start", "runs.windows")

    def keep(batches):
        for b in batches:
            out, texts = [], []
            starts, windows = b.column(2), b.column(3)
            for lo, data, offsets in text_chunks(b.column(1)):
                s, e, first = words_of(data, offsets)
                for i in range(len(offsets) - 1):
                    a, z = first[i], first[i + 1]
                    begin, end, n_removed, n_spans = s[a:z], e[a:z], 0, 0
                    if starts[lo + i].is_valid and len(starts[lo + i]):
                        r = np.stack([np.asarray(starts[lo + i].values), np.asarray(windows[lo + i].values)], 1).astype(np.int64)
                        gone = covered_words(z - a, r, window)
                        n_removed = int(gone.sum())
                        n_spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
                        begin, end = begin[~gone], end[~gone]
                    raw = data[offsets[i]:offsets[i + 1]]
                    if n_removed:
                        mark = np.zeros(len(raw) + 1, np.int8)
                        np.add.at(mark, begin - offsets[i], 1)
                        np.add.at(mark, end - offsets[i], -1)
                        raw = np.where(np.cumsum(mark[:-1]) > 0, raw, 32).astype(np.uint8)
                    kept = b" ".join(raw.tobytes().split())
                    out.append((int(z - a), n_removed, hashlib.sha256(kept).hexdigest(), n_spans))
                    if with_text:
                        texts.append(kept.decode())
            cols = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.int64())] + [pa.array(texts, pa.string())] * with_text,
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "n_spans"] + ["kept_text"] * with_text)

    return joined.mapInArrow(keep, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, n_spans long"
                             + ", kept_text string" * with_text)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))
