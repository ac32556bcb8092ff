"""Exact Jaccard join of word n-gram sets by prefix trees.

Sets are ordered globally, rare grams first: by the size class of a counter that all documents fill (a fixed number of
counters), then by hash. Any order that is the same for all sets gives exact results; a rare-first one gives few
candidates. Two sets as alike as asked share a gram in their prefixes, so the sets hang in the subtrees of their prefix
grams. Equal sets are one class; subtrees with equal members are one subtree; a subtree too large for one task is split
into block pairs. In a subtree, lengths and a profile of each set (its grams counted by hash; the distance of two
profiles is at most the number of grams that differ) leave the candidates, and their connected groups get their whole sets: each group is stored in a trie that
shares common beginnings, and a set walks it, adding up its overlap along shared segments, leaving subtrees that the
remaining lengths cannot lift to the threshold, and subtrees already in its component.

Results for odd input: null text and text without words have an empty set (0 grams), linked with nothing; a text of
fewer words than a gram is one gram; null ids are kept, come first and make a null component; repeated rows are linked; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.frames import coordinates, cut, table
from caseloom.llm.graph import components
from caseloom.llm.hashing import LOWER, U, gram_starts, mix, range_hash, text_chunks, word_hashes, words_of

GRAM = 3
NUMERATOR, DENOMINATOR = 90, 100  # alike: DENOMINATOR * intersection >= NUMERATOR * union
COUNTER_BITS = 20  # 2^20 counters order the grams
SLICES = 64
LEAST_PROFILE = 64  # counters of a profile, at least; a large set has one for about eight grams
BLOCK = 512


def gram_sets(column: pa.Array, gram: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct gram hashes in ascending order) of every text, letters A-Z lower-cased."""
    for lo, data, offsets in text_chunks(column):
        s, e, first = words_of(data, offsets)
        h = word_hashes(LOWER[data], s, e)
        starts, bounds = gram_starts(first, gram)
        grams = range_hash(h, starts, starts + gram)
        for i in range(len(offsets) - 1):
            n = first[i + 1] - first[i]
            if n >= gram:
                yield lo + i, np.unique(grams[bounds[i]:bounds[i + 1]])
            elif n:
                yield lo + i, mix(range_hash(h, first[i:i + 1], first[i + 1:i + 2]) + U(n))
            else:
                yield lo + i, np.zeros(0, U)


@dataclass(frozen=True)
class Alike:
    """The threshold: den * intersection >= num * union, that is (num + den) * intersection >= num * (sum of lengths)."""

    num: int = NUMERATOR
    den: int = DENOMINATOR

    def holds(self, overlap: int, lengths: int) -> bool:
        return (self.num + self.den) * overlap >= self.num * lengths

    def least_overlap(self, lengths):
        return -(-self.num * lengths // (self.num + self.den))

    def shortest(self, n):
        """The length of the shortest set that can be alike to one of n."""
        return -(-n * self.num // self.den)

    def prefix(self, n: int) -> int:
        return n - self.shortest(n) + 1 if n else 0


def gram_classes(rows: DataFrame, gram: int = GRAM) -> np.ndarray:
    """The size class (log2) of each counter, over the grams of all texts; 2^COUNTER_BITS bytes whatever the input."""
    size = 1 << COUNTER_BITS

    def count(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            for _, s in gram_sets(b.column(0), gram):
                total += np.bincount((s >> U(64 - COUNTER_BITS)).astype(np.int64), minlength=size) if len(s) > 4096 else 0
                if len(s) <= 4096:
                    np.add.at(total, (s >> U(64 - COUNTER_BITS)).astype(np.int64), 1)
        if total.any():
            parts = np.minimum(total, (1 << 31) - 1).astype("<i4").reshape(SLICES, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts])],
                                             names=["slice", "counts"])

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                part = np.frombuffer(x.as_buffer(), "<i4")
                totals[k] = totals[k] + part if k in totals else part.astype(np.int64)
        for k, total in totals.items():
            level = np.floor(np.log2(total + 1)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([level.tobytes()])], names=["slice", "levels"])

    got = rows.select("text").mapInArrow(count, "slice int, counts binary").repartition(SLICES, "slice").mapInArrow(
        add, "slice int, levels binary").collect()
    levels = np.zeros((SLICES, size // SLICES), np.uint8)
    for r in got:
        levels[r["slice"]] = np.frombuffer(r["levels"], np.uint8)
    return levels.reshape(-1)


def profile_of(grams: np.ndarray) -> np.ndarray:
    """Grams counted by the low bits of their hash, in a power of two of counters that grows with the set."""
    width = max(LEAST_PROFILE, 1 << (len(grams) >> 3).bit_length())
    return np.minimum(np.bincount((grams & U(width - 1)).astype(np.int64), minlength=width), 65535).astype("<u2")


def fold(profile: np.ndarray, width: int) -> np.ndarray:
    """The profile with fewer counters: those whose low bits are equal are added up."""
    return profile.astype(np.int32).reshape(-1, width).sum(axis=0, dtype=np.int32)


def _summaries(batches, gram: int, alike: Alike, levels: np.ndarray):
    for b in batches:
        n, digest, profile, prefix = [], [], [], []
        for _, s in gram_sets(b.column(1), gram):
            n.append(len(s))
            digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            profile.append(profile_of(s).tobytes())
            p = alike.prefix(len(s))
            if p:
                rank = (levels[(s >> U(64 - COUNTER_BITS)).astype(np.int64)].astype(U) << U(56)) | (mix(s) >> U(8))
                s = s[np.argpartition(rank, p - 1)[:p]] if p < len(s) else s
            prefix.append(s.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int32()), pa.array(digest, pa.binary()), pa.array(profile, pa.binary()),
             pa.array(prefix, pa.list_(pa.int64()))], names=["at", "n", "digest", "profile", "prefix"])


class Links:
    """Union-find over the members of one group."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _groups(batches, width: int):
    """Rows of one key (first column) at a time; rows come sorted by it. A group is bounded by the block size."""
    held = []
    for b in batches:
        key = np.asarray(b.column(0))
        edges = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)])) if len(key) else [0]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            part = b.slice(lo, hi - lo)
            if held and held[0].column(0)[0].as_py() != key[lo]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _edge_batches(pairs: Iterator[tuple[int, int]]):
    out = []
    for p in pairs:
        out.append(p)
        if len(out) == 8192:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])


def _candidates(batches, alike: Alike):
    """Edges that span the candidate groups of each subtree: pairs whose lengths and profiles allow the threshold."""
    def pairs():
        for t in _groups(batches, 4):
            if t.num_rows < 2:
                continue
            node, n = np.asarray(t.column("node").combine_chunks()), np.asarray(t.column("n").combine_chunks()).astype(np.int64)
            order = np.argsort(n, kind="stable")
            node, n = node[order], n[order]
            raw = t.column("profile").to_pylist()
            raw = [np.frombuffer(raw[i], "<u2") for i in order]
            width = np.array([len(p) for p in raw])  # ascending, as the lengths are
            folded: dict[int, tuple[int, np.ndarray]] = {}  # the profiles, in that many counters, of sets from a place on
            for w in np.unique(width).tolist():
                first = int(np.searchsorted(width, w))
                longest = n[width == w].max() * alike.den // alike.num  # no longer set is alike to one of this width
                folded[w] = first, np.stack([fold(p, w) for p in raw[first:int(np.searchsorted(n, longest, "right"))]])
            links = Links(len(n))
            for i in range(1, len(n)):
                lo = int(np.searchsorted(n, alike.shortest(n[i])))
                if lo >= i:
                    continue
                first, prof = folded[int(width[lo])]
                differ = np.abs(prof[lo - first:i - first] - prof[i - first]).sum(axis=1)
                both = n[lo:i] + n[i]
                for j in np.flatnonzero(differ <= both - 2 * alike.least_overlap(both)) + lo:
                    if links.join(i, int(j)):
                        yield int(node[i]), int(node[j])
    yield from _edge_batches(pairs())


class Node:
    """A node of a compacted prefix tree: the grams since its parent, the sets that end here, and what lies below."""

    __slots__ = ("any", "children", "depth", "least", "members", "most", "one", "segment")


def build_trie(sets: list[np.ndarray], members: list[int]) -> list[Node]:
    """The nodes, parents first, of the tree over sets given as ascending rank arrays in lexicographic order."""
    lengths = np.array([len(s) for s in sets])
    nodes: list[Node] = []
    todo: list[tuple[int, int, int, Node | None]] = [(0, len(sets), 0, None)]
    while todo:
        lo, hi, depth, parent = todo.pop()
        first, last = sets[lo], sets[hi - 1]
        common = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:common] != last[depth:common])
        end = depth + int(differ[0]) if len(differ) else common
        node = Node()
        node.segment, node.depth, node.children = first[depth:end], end, []
        node.least, node.most = int(lengths[lo:hi].min()), int(lengths[lo:hi].max())
        node.any, node.one = members[lo], hi - lo == 1  # one: all sets below are known to be in one component
        at = lo
        while at < hi and lengths[at] == end:  # a set stands before those it begins
            at += 1
        node.members = members[lo:at]
        nodes.append(node)
        if parent is not None:
            parent.children.append(node)
        begin = at
        for at in range(begin + 1, hi + 1):
            if at == hi or sets[at][end] != sets[begin][end]:
                todo.append((begin, at, end, node))
                begin = at
    return nodes


def _walk(root: Node, x: int, mask: np.ndarray, n: int, links: Links, alike: Alike):
    """Link set x with every set of the trie that is alike; yields the links that join components."""
    stack = [(root, 0)]
    while stack:
        t, overlap = stack.pop()
        if t.one and links.find(t.any) == links.find(x):
            continue
        overlap += int(mask[t.segment].sum())
        best = min(max(n - overlap + t.depth, t.least), t.most)  # the length with the most room
        if not alike.holds(overlap + min(n - overlap, best - t.depth), n + best):
            continue
        for m in t.members:
            if alike.holds(overlap, n + t.depth) and links.join(x, m):
                yield x, m
        stack += [(c, overlap) for c in t.children]


def _settle(nodes: list[Node], links: Links) -> None:
    """Mark subtrees whose sets are all in one component."""
    for t in reversed(nodes):
        if not t.one and all(c.one for c in t.children):
            root = links.find(t.any)
            t.one = all(links.find(x) == root for x in t.members) and all(links.find(c.any) == root for c in t.children)


def trie_links(sets: list[np.ndarray], alike: Alike = Alike()) -> Iterator[tuple[int, int]]:
    """Links (i, j) that span the components of alike sets. Grams that most sets share come first in the trie."""
    links = Links(len(sets))
    if len(sets) == 2:
        a, b = sets
        if alike.holds(len(np.intersect1d(a, b, assume_unique=True)), len(a) + len(b)):
            yield 0, 1
        return
    grams, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(grams), np.int32)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(grams), dtype=np.int32)
    ranked = [np.sort(r) for r in np.split(rank[place], np.cumsum([len(s) for s in sets])[:-1])]
    order = sorted(range(len(sets)), key=lambda i: ranked[i].astype(">i4").tobytes())
    nodes = build_trie([ranked[i] for i in order], order)
    root = nodes[0]
    mask = np.zeros(len(grams), bool)
    for seen, x in enumerate(order):
        if root.one:
            return
        mask[ranked[x]] = True
        yield from _walk(root, x, mask, len(ranked[x]), links, alike)
        mask[ranked[x]] = False
        if seen & (seen - 1) == 0 or seen % 64 == 0:
            _settle(nodes, links)


def _verified(batches, alike: Alike):
    def pairs():
        for t in _groups(batches, 3):
            if t.num_rows < 2:
                continue
            node = t.column("node").to_pylist()
            sets = [np.frombuffer(x, "<u8") for x in t.column("grams").to_pylist()]
            for i, j in trie_links(sets, alike):
                yield node[i], node[j]
    yield from _edge_batches(pairs())


def _blocks(df: DataFrame, key: str, size: str) -> DataFrame:
    """Rows keyed by ``task``: a group of at most BLOCK rows is one task, a larger one is split into block pairs, so
    that any two of its rows meet in one task of at most two blocks."""
    n = F.ceil(F.col(size) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), n).cast("int")
    other = F.explode(F.when(n <= 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n - 1)))
    return df.withColumn("__own", own).withColumn("__other", other).withColumn(
        "task", F.xxhash64(key, F.least("__own", "__other"), F.greatest("__own", "__other"))).drop("__own", "__other")


def link_components(rows: DataFrame, gram: int = GRAM, alike: Alike = Alike()) -> DataFrame:
    """(at, n_shingles, component) for rows (at, text) with unique ``at``; component is the least ``at`` reachable."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    levels = spark.sparkContext.broadcast(gram_classes(rows, gram))
    seen = cut(rows.select("at", "text").mapInArrow(lambda b: _summaries(b, gram, alike, levels.value),
                                                    "at long, n int, digest binary, profile binary, prefix array<bigint>"))
    classes = seen.where("n > 0").groupBy("digest").agg(F.min("at").alias("node"))  # equal sets: one class
    firsts = seen.join(classes.select(F.col("node").alias("at")), "at").select(F.col("at").alias("node"), "n", "profile", "prefix")
    firsts = cut(firsts)

    # one shuffle by gram serves the counts and the join that brings them back
    hung = firsts.select("node", F.explode("prefix").alias("gram")).repartition(parts, "gram")
    h = F.xxhash64("node")
    subtrees = hung.groupBy("gram").agg(F.count("*").alias("size"), F.bit_xor(h).alias("x"),
                                        F.sum(h.bitwiseAND(F.lit(0xFFFFFF))).alias("s")).where("size > 1")
    same = hung.join(subtrees, "gram").select(F.xxhash64("size", "x", "s").alias("key"), "size", "node").distinct()
    members = _blocks(same.join(firsts.select("node", "n", "profile"), "node"), "key", "size")
    found = members.select("task", "node", "n", "profile").repartition(parts, "task").sortWithinPartitions("task").mapInArrow(
        lambda b: _candidates(b, alike), "a long, b long")
    groups = cut(components(found))

    sizes = groups.groupBy("root").agg(F.count("*").alias("size"))
    wanted = groups.join(sizes, "root").select(F.col("node").alias("at"), "root", "size")

    def whole(batches):
        for b in batches:
            sets = [s.tobytes() for _, s in gram_sets(b.column(3), gram)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(sets, pa.binary())],
                                             names=["node", "root", "size", "grams"])

    sets = rows.join(wanted.hint("shuffle_hash"), "at").select("at", "root", "size", "text").mapInArrow(
        whole, "node long, root long, size long, grams binary")
    tasks = _blocks(sets, "root", "size").select("task", "node", "grams")
    links = tasks.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(
        lambda b: _verified(b, alike), "a long, b long")
    roots = components(links)
    of_class = classes.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("component"))
    return seen.select("at", "n", "digest").join(of_class, "digest", "left").select(
        "at", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "at").alias("component"))


def near_duplicates(docs: DataFrame, gram: int = GRAM, alike: Alike = Alike(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    rows = coordinates(docs, id_col, text_col)
    out = link_components(rows, gram, alike)
    ids = rows.select("at", "doc_id")
    named = out.join(ids, "at").join(ids.select(F.col("at").alias("component"), F.col("doc_id").alias("component_id")), "component")
    return named.select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, gram: int, alike: Alike, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first row (by id, then text) of every component; rows with an empty set all stay. All columns are kept."""
    rows = coordinates(docs, id_col, text_col, keep=True)
    out = link_components(rows.select(F.col("__at").alias("at"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), gram, alike)
    firsts = out.where("at = component").select(F.col("at").alias("__at"))
    return rows.join(firsts.hint("shuffle_hash"), "__at", "left_semi").select(*docs.columns)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
