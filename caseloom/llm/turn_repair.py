"""Conversation structure repair: the cheapest edits that give a well-formed turn order, by a persistent audit DP.

A repaired conversation is empty, or an optional system turn and then pairs of a user and an assistant turn. Walking a
conversation's turns in order, the DP keeps for each state (nothing yet, after system, after user, after assistant) the
cheapest edits so far; of equally cheap ones, those whose initials are ASCII-least. Edit prefixes are shared as linked
nodes (``Audits``), each with its ancestors at powers of two and a rolling hash: a tie is settled by a search for the
longest common prefix, and a common prefix that only hashes claim is verified letter by letter.

A conversation may hold any share of the rows. Turns are range-sorted, so it is dealt over as many tasks as its rows
fill; each task solves runs of at most ``SEGMENT_ROWS`` turns for every state that a run can begin in, and the runs of
a conversation are folded in order. The repaired turns leave in one sorted stream per conversation.

Results for odd input: null role or text counts as one space (a null text is blank); null turns come first; turns with
equal numbers go by role, then text, by code point; equal rows are adjacent, all but the first duplicates; a null
conversation id is a conversation of its own; a role counts by its first character, and an empty or unknown one must be
reroled or deleted; texts of any length are handled one batch at a time; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.frames import cut, ranked, table

SEGMENT_ROWS = 4096
OUT_ROWS = 4096  # rows of a batch that a task hands on
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)  # the state that a reroled or inserted turn leads to
ROLES = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs; keeping costs nothing
FINE, BLANK, DUPLICATE, CUT_OFF = range(4)  # a turn's fault


class Audits:
    """Strings of edit initials as linked nodes that share their prefixes; node 0 is the empty string."""

    BASE, MODULUS = 0x1F3D5B79A2C4E681, (1 << 61) - 1

    def __init__(self) -> None:
        self.letter, self.depth, self.hash, self.up, self.alike = [""], [0], [0], [[]], [0]

    def push(self, parent: int, letter: str) -> int:
        node, ups = len(self.letter), [parent]
        while len(self.up[ups[-1]]) >= len(ups):
            ups.append(self.up[ups[-1]][len(ups) - 1])
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * self.BASE + ord(letter)) % self.MODULUS)
        self.up.append(ups)
        self.alike.append(node)
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _lifted(self, node: int, depth: int) -> int:
        over = self.depth[node] - depth
        for k in range(over.bit_length()):
            if over >> k & 1:
                node = self.up[node][k]
        return node

    def _known(self, node: int) -> int:
        while self.alike[node] != node:
            self.alike[node] = self.alike[self.alike[node]]
            node = self.alike[node]
        return node

    def _same(self, x: int, y: int) -> bool:
        """Whether two nodes of one depth hold the same string. What is verified once is not walked again."""
        while (x := self._known(x)) != (y := self._known(y)):
            if self.letter[x] != self.letter[y]:
                return False
            self.alike[x] = y
            x, y = self.up[x][0], self.up[y][0]
        return True

    def before(self, x: int, y: int) -> bool:
        """Whether x's string is less than y's."""
        depth = min(self.depth[x], self.depth[y])
        a, b = self._lifted(x, depth), self._lifted(y, depth)
        if a == b or self.hash[a] == self.hash[b]:
            if self._verified(a, b):
                return self.depth[x] < self.depth[y]
            return self.text(x) < self.text(y)
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if self._verified(self.up[a][0], self.up[b][0]):
            return self.letter[a] < self.letter[b]
        return self.text(x) < self.text(y)  # the hashes collided

    def _verified(self, x: int, y: int) -> bool:
        """``_same``, leaving nothing marked alike if the walk finds a difference."""
        if self._same(x, y):
            return True
        self.alike = list(range(len(self.letter)))
        return False


def cheapest(turns: list[tuple[str, int]], begin: int) -> list[tuple[int, str] | None]:
    """For each state that ``turns`` (initial, fault) can end in from ``begin``: the least cost and its least audit."""
    audits = Audits()
    best: list[tuple[int, int] | None] = [None] * 4
    best[begin] = (0, 0)

    def offer(to: list, state: int, cost: int, parent: int, letter: str) -> None:
        held = to[state]
        if held is None or cost < held[0]:
            to[state] = (cost, parent, letter)
        elif cost == held[0]:
            mine = audits.push(parent, letter)
            theirs = held[1] if held[2] is None else audits.push(held[1], held[2])
            to[state] = (cost, mine if audits.before(mine, theirs) else theirs, None)

    def settle(to: list) -> list:
        return [t and (t[0], t[1] if t[2] is None else audits.push(t[1], t[2])) for t in to]

    def with_inserts(now: list) -> list:
        for state, sources in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            to = [n and (*n, None) for n in now]
            for q in sources:
                if now[q]:
                    offer(to, state, now[q][0] + INSERT, now[q][1], "I")
            now = settle(to)
        return now

    best = with_inserts(best)
    for initial, fault in turns:
        to: list = [None] * 4
        keeps = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}.get(initial, {})
        extra = TRUNCATED if fault == CUT_OFF else 0
        for q, held in enumerate(best):
            if held is None:
                continue
            cost, node = held
            offer(to, q, cost + DELETE, node, "D")
            if fault in (FINE, CUT_OFF):
                if q in keeps:
                    offer(to, keeps[q], cost + extra, node, "K")
                offer(to, FOLLOWS[q], cost + extra + REROLE, node, "R")
        best = with_inserts(settle(to))
    return [b and (b[0], audits.text(b[1])) for b in best]


def damage(turns: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) of ``conversations`` with seeded faults, by crc32 of ``conv_id:turn`` modulo 20."""
    space = F.lit(" ")
    draw = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]).cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return turns.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), F.when(draw == 4, "user").otherwise(role).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def ordered(turns: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, place, fault) in the order of their conversations, dealt by ranges of it."""
    rows = turns.select("conv", F.col("turn").cast("long").alias("turn"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = rows.withColumn("row", F.monotonically_increasing_id())  # spreads rows that are alike
    keys = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    return ranked(rows, keys, "place").drop("row")


def _faults(placed: DataFrame) -> DataFrame:
    """Rows (place, conv, turn, initial, fault) without texts."""
    digest = F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"), 256))
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    light = placed.select("place", "conv", "turn", F.substring("role", 1, 1).alias("initial"), digest.alias("digest"), last.alias("last"))
    firsts = light.groupBy("conv", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("last") == "", BLANK).when(F.col("first").isNull(), DUPLICATE).when(
        ~F.col("last").isin(".", "!", "?"), CUT_OFF).otherwise(FINE)
    return light.join(firsts, "place", "left").select("place", "conv", "turn", "initial", fault.alias("fault"))


_SEGMENT = ("place long, n long, blank long, duplicate long, truncated long, illegal long, turns long, least long, most long, "
            "head string, tail string, costs array<long>, audits array<string>")


def _illegal(before: str, after: str) -> int:
    return int(before + after not in ("su", "ua", "au"))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _arrow(conv: str, fields: str) -> tuple[str, pa.Schema]:
    """The DDL of (conv, fields) and its Arrow schema."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return f"conv {conv}, {fields}", to_arrow_schema(StructType.fromDDL(f"conv {conv}, {fields}"))


def _segment(conv, turns: list[tuple], begins: tuple[int, ...]) -> tuple:
    """One row of ``_SEGMENT`` for consecutive turns (place, turn, initial, fault) of a conversation."""
    of_begin = {q: cheapest([t[2:] for t in turns], q) for q in begins}
    ends = [e for q in range(4) for e in of_begin.get(q, [None] * 4)]
    faults, numbers, initials = [t[3] for t in turns], [t[1] for t in turns if t[1] is not None], [t[2] for t in turns]
    return (conv, turns[0][0], len(turns), faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT_OFF),
            sum(map(_illegal, initials, initials[1:])), len(set(numbers)), min(numbers, default=None), max(numbers, default=None),
            initials[0], initials[-1], [e and e[0] for e in ends], [e and e[1] for e in ends])


def _segments(schema: pa.Schema, segment_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            whole = False  # the first conversation of a range may go on from the range before
            for conv, turns in groupby(_rows(batches), key=lambda r: r[1]):
                held: list[tuple] = []
                for place, _, turn, initial, fault in turns:
                    if len(held) == segment_rows:
                        yield _segment(conv, held, (START,) if whole else (START, SYSTEM, USER, ASSISTANT))
                        held, whole = [], False
                    held.append((place, turn, initial, fault))
                yield _segment(conv, held, (START,) if whole else (START, SYSTEM, USER, ASSISTANT))
                whole = True

        yield from _batches(out(), schema)
    return run


def _less(x: tuple, y: tuple) -> bool:
    """Whether x's pieces, put together, are less than y's; both are (earlier pieces, piece) and share what they can."""
    a, b = [], []
    while x is not y:
        a.append(x[1])
        b.append(y[1])
        x, y = x[0], y[0]
    return "".join(reversed(a)) < "".join(reversed(b))


def folded(segments: Iterator[tuple]) -> tuple:
    """(place, blank, duplicate, truncated, illegal, gaps, cost, audit) of a conversation from its segments in order."""
    best: list[tuple[int, tuple | None] | None] = [(0, None), None, None, None]
    sums, turns, least, most, tail, first = [0, 0, 0, 0], 0, None, None, None, None
    for place, _, *counts, n_turns, low, high, head, last, costs, audits in segments:
        first = place if first is None else first
        sums = [a + b for a, b in zip(sums, counts)]
        sums[3] += 0 if tail is None else _illegal(tail, head)
        turns += n_turns - (1 if low is not None and low == most else 0)
        least, most, tail = (low if least is None else least), (most if high is None else high), last
        now: list = [None] * 4
        for q, held in enumerate(best):
            for end in range(4) if held else ():
                cost = costs[4 * q + end]
                if cost is None:
                    continue
                path = (held[0] + cost, (held[1], audits[4 * q + end]))
                if now[end] is None or path[0] < now[end][0] or path[0] == now[end][0] and _less(path[1], now[end][1]):
                    now[end] = path
        best = now
    ways = [w for w in (best[START], best[ASSISTANT]) if w]
    cost = min(w[0] for w in ways)
    node = None
    for w in ways:
        if w[0] == cost and (node is None or _less(w[1], node)):
            node = w[1]
    pieces = []
    while node:
        pieces.append(node[1])
        node = node[0]
    return (first, *sums, 0 if least is None else most - least + 1 - turns, cost, "".join(reversed(pieces)))


def audit(placed: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """conv, place (of its first turn), blank, duplicate, truncated, illegal, gaps, cost, audit for ``ordered`` turns."""
    conv = placed.schema["conv"].dataType.simpleString()
    ddl, schema = _arrow(conv, _SEGMENT)
    light = _faults(placed).repartitionByRange("place").sortWithinPartitions("place")
    segments = light.mapInArrow(_segments(schema, segment_rows), ddl)
    out_ddl, out_schema = _arrow(conv, "place long, blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = groupby(_rows(batches), key=lambda r: r[0])
        yield from _batches(((c, *folded(s[1:] for s in rows)) for c, rows in parts), out_schema)

    return segments.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "place").mapInArrow(fold, out_ddl)


def apply_audit(placed: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired turns: conv, at (from 0), role, text, edit; a conversation's turns are in order in one partition."""
    conv = placed.schema["conv"].dataType.simpleString()
    step_ddl, step_schema = _arrow(conv, "place long, step string")
    ddl, schema = _arrow(conv, "at long, role string, text string, edit string")

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(((c, place + i, m.group()) for c, place, letters in _rows(batches)
                             for i, m in enumerate(re.finditer("I*[DKR]|I+", letters))), step_schema)

    def edited(step: str, role: str | None, text: str | None, state: int) -> Iterator[tuple[int, str, str, str]]:
        for letter in step:
            if letter == "K":
                state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
                yield state, role, text, letter
            elif letter != "D":
                state = FOLLOWS[state]
                yield state, ROLES[state], "" if letter == "I" else text, letter

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for c, rows in groupby(_rows(batches), key=lambda r: r[0]):
                state, at = START, 0
                for _, pair in groupby(rows, key=lambda r: r[1]):
                    step, role, text = "", None, None
                    for r in pair:
                        step, role, text = (r[2], role, text) if r[2] is not None else (step, r[3], r[4])
                    for state, said_by, words, letter in edited(step, role, text, state):
                        yield c, at, said_by, words, letter
                        at += 1

        yield from _batches(out(), schema)

    none = F.lit(None).cast("string")
    dealt = audits.select("conv", "place", "audit").mapInArrow(steps, step_ddl).select("conv", "place", "step", none.alias("role"), none.alias("text"))
    rows = dealt.unionAll(placed.select("conv", "place", none.alias("step"), "role", "text"))
    return rows.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "place").mapInArrow(repaired, ddl)


def digests(repaired: DataFrame) -> DataFrame:
    """conv and the sha256 of its ``role:text`` lines, for the rows of ``apply_audit`` in the order they come."""
    ddl, schema = _arrow(repaired.schema["conv"].dataType.simpleString(), "sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for c, rows in groupby(_rows(batches), key=lambda r: r[0]):
                sha = hashlib.sha256()
                for _, at, role, text, _ in rows:
                    sha.update((("\n" if at else "") + f"{role}:{text}").encode())
                yield c, sha.hexdigest()

        yield from _batches(out(), schema)

    return repaired.mapInArrow(run, ddl)


def report(conversations: DataFrame, turns: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """A row for every conv of ``conversations``: counts of faults, cost and audit of the repair of ``turns``, its digest."""
    placed = ordered(turns)
    audits = cut(audit(placed, segment_rows))
    shas = digests(apply_audit(placed, audits))
    named = conversations.select("conv").distinct()
    a, s = audits.withColumnRenamed("conv", "of"), shas.withColumnRenamed("conv", "by")
    joined = named.join(a, F.col("conv").eqNullSafe(F.col("of")), "left").join(s, F.col("conv").eqNullSafe(F.col("by")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return report(conversations.select(F.col("conv_id").alias("conv")), damage(conversations))
