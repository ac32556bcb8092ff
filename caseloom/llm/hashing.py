"""Rolling hashes over Arrow text columns in numpy: words, k-grams of words, k-grams of code points.

All arithmetic is modulo 2^64. A prefix sum of value * BASE^position makes the hash of any range one subtraction
and one multiplication by a power of the inverse base, so a batch costs the same whatever the gram length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
CHUNK_BYTES = 1 << 20  # texts are hashed in chunks of about this size, to bound the temporaries


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(BASE) + U(seed))


BYTES = (_byte_values(0), _byte_values(7))  # two independent functions: together 128 bits
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


def range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for many ranges at once."""
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(BASE, len(values)), out=sums[1:])
    return mix((sums[end] - sums[start]) * powers(INVERSE, len(values) + 1)[start])


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, UTF-8 bytes, row offsets) for runs of rows of about CHUNK_BYTES; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, "right")) - 1)
        yield lo, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte places of the words of a chunk, and the word index where each row begins."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:n + 1] = ~SEPARATOR[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:n + 1] & (~inside[:n] | edge[:n]))
    end = np.flatnonzero(inside[1:n + 1] & (~inside[2:] | edge[1:])) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    return range_hash(BYTES[which][data], start, end)


def gram_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word indices where a k-gram inside one row begins, and the rows' boundaries in that list."""
    counts = np.maximum(np.diff(first) - (k - 1), 0)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    row = np.repeat(np.arange(len(counts)), counts)
    return first[row] + np.arange(bounds[-1]) - bounds[row], bounds


def slide_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys, by doubling."""
    size, out = 1, keys
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:len(out) - (width - size)], out[width - size:])
