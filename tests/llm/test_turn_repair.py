"""Conversation repair against a plain Python reading of its rules."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from caseloom.llm import turn_repair as tr

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
FORM = re.compile(r"(s?(ua)+)?")


def run_edits(rows, audit):
    """(cost, initials, lines) of an audit, or None if it doesn't fit the rows (role, text, fault)."""
    cost, out, i = 0, [], 0
    for letter in audit:
        state = out[-1][0][:1] if out else ""
        follow = "assistant" if state == "u" else "user"
        if letter == "I":
            out.append((follow, ""))
            cost += 3
            continue
        if i == len(rows):
            return None
        role, text, fault = rows[i]
        i += 1
        if letter == "D":
            cost += 4
            continue
        if fault in (1, 2):
            return None
        cost += (3 if fault == 3 else 0) + (3 if letter == "R" else 0)
        out.append((role if letter == "K" else follow, text))
    initials = "".join(r[:1] or "?" for r, _ in out)
    return (cost, initials, out) if i == len(rows) and FORM.fullmatch(initials) else None


def enumerated(rows):
    """The cheapest, ASCII-least audit of a few rows by trying all with at most two inserts in a gap."""
    gaps, best = ["", "I", "II"], None
    for letters in product("KRD", repeat=len(rows)):
        for inserts in product(gaps, repeat=len(rows) + 1):
            audit = "".join(g + x for g, x in zip(inserts, letters)) + inserts[-1]
            got = run_edits(rows, audit)
            if got and (best is None or (got[0], audit) < best):
                best = (got[0], audit)
    return best


def greedy(rows):
    """Costs to go from the end, then the least letter that stays cheapest: another way to the same audit."""
    far = 10 ** 9
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}

    def moves(i, q):
        role, _, fault = rows[i]
        extra = 3 if fault == 3 else 0
        yield "D", 4, q
        if fault not in (1, 2):
            yield "R", 3 + extra, follow[q]
            k = role[:1]
            if (k == "s" and q == "") or (k == "u" and q != "u") or (k == "a" and q == "u"):
                yield "K", extra, k

    def with_insert(g):
        for q in ("u", "", "s", "a", "u"):
            g[q] = min(g[q], 3 + g[follow[q]])
        return g

    go = [None] * (len(rows) + 1)
    go[-1] = with_insert({"": 0, "s": far, "u": far, "a": 0})
    for i in reversed(range(len(rows))):
        go[i] = with_insert({q: min(c + go[i + 1][t] for _, c, t in moves(i, q)) for q in ("", "s", "u", "a")})
    i, q, out = 0, "", []
    while True:
        if i == len(rows) and go[i][q] == 0:
            return go[0][""], "".join(out)
        ways = [(x, c + go[i + 1][t], i + 1, t) for x, c, t in (moves(i, q) if i < len(rows) else ())]
        ways.append(("I", 3 + go[i][follow[q]], i, follow[q]))
        letter, _, j, t = min(w for w in ways if w[1] == go[i][q])
        out.append(letter)
        i, q = j, t


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        if draw == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(draw, text)
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def expected(rows, after=None):
    """The contract, row by row; ``rows`` name the conversations, ``after`` are their turns."""
    after = damaged(rows) if after is None else after
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in mine:
            body = text.rstrip(" \t\n\v\f\r")
            faults.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
            seen.add((role, text))
        with_fault = [(r[2], r[3], f) for r, f in zip(mine, faults)]
        cost, audit = greedy(with_fault)
        lines = "\n".join(f"{r}:{t}" for r, t in run_edits(with_fault, audit)[2])
        turns = {r[1] for r in mine} - {None}
        initials = [r[2][:1] for r in mine]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256(lines.encode()).hexdigest())
    return out


def got(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def some_rows(rng, n, roles=("user", "assistant", "system", "tool")):
    return [(rng.choice(roles), "", rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]


def test_cheapest_audits_by_trying_all():
    rng = random.Random(1)
    for n in range(5):
        for _ in range(25 if n < 4 else 6):
            rows = some_rows(rng, n)
            ends = tr.cheapest([(r[:1], f) for r, _, f in rows], tr.START)
            assert min(e for e in (ends[tr.START], ends[tr.ASSISTANT]) if e) == enumerated(rows) == greedy(rows), rows


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 3, 1])
def test_long_ties_and_hash_collisions(monkeypatch, modulus):
    monkeypatch.setattr(tr.Audits, "MODULUS", modulus)  # 3 and 1: nearly all hashes collide, every tie rests on the letters
    rng = random.Random(2)
    for roles in (("tool",), ("user", "tool"), ("user", "assistant", "system", "tool"), ("assistant",)):
        for n in (40, 150):
            rows = some_rows(rng, n, roles)
            ends = tr.cheapest([(r[:1], f) for r, _, f in rows], tr.START)
            assert min(e for e in (ends[tr.START], ends[tr.ASSISTANT]) if e) == greedy(rows)


def test_linked_strings_compare_like_strings():
    rng, audits = random.Random(3), tr.Audits()
    nodes = [0]
    for _ in range(400):
        nodes.append(audits.push(rng.choice(nodes[-6:]), rng.choice("DK")))
    for _ in range(3000):
        x, y = rng.choice(nodes), rng.choice(nodes)
        if audits.text(x) != audits.text(y):
            assert audits.before(x, y) == (audits.text(x) < audits.text(y))


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(tr.op11_turn_repair(spark, sf)) == expected(rows)


def odd_rows():
    rng = random.Random(4)
    rows = [(c, rng.choice([None, 1, 2, 3, 4, 9]), rng.choice(["user", "assistant", "system", "", None, "tool", "unit"]),
             rng.choice(["a.", "b", " ", "", None, "c!\n", "d? ", "é.", "long " * 30000 + "."])) for c in [*range(40), None] for _ in range(rng.randrange(1, 9))]
    return rows + rows[::5] + [(77, 1, "user", "again.")] * 60  # repeated rows, and a conversation of copies


def test_odd_rows_and_extra_columns(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("place", "fault", "at", "edit", "conv", "audit", "copy", "row", "__mid"):
        df = df.withColumn(c, F.lit("clash"))
    named = df.select(F.col("conv_id").alias("conv"))
    assert got(tr.report(named, tr.damage(df))) == expected(rows)
    assert tr.report(named.limit(0), tr.damage(df.limit(0))).collect() == []


def test_a_conversation_dealt_over_tasks(spark):
    """One conversation holds most rows: segments of seven turns from several ranges are folded to the same answer."""
    rng = random.Random(5)
    rows = [(1, rng.randrange(900), rng.choice(["user", "assistant", "system", "tool"]), f"t{rng.randrange(400)}" + rng.choice([".", "?", ""]))
            for _ in range(1200)] + [(2, 1, "user", "x."), (3, 5, "user", "gone")]
    df = spark.createDataFrame(rows, SCHEMA)
    turns = df.withColumnRenamed("conv_id", "conv").where("conv != 3")
    after = [r for r in rows if r[0] != 3]
    assert got(tr.report(df.select(F.col("conv_id").alias("conv")), turns, 7)) == expected(rows, after)


def test_repaired_turns_are_rows(spark):
    turns = spark.createDataFrame([(1, 0, "assistant", "hi."), (1, 1, "user", "a?"), (1, 2, "assistant", "b.")], "conv int, turn int, role string, text string")
    placed = tr.ordered(turns)
    rows = [tuple(r) for r in tr.apply_audit(placed, tr.audit(placed)).orderBy("at").collect()]
    assert rows == [(1, 0, "user", "", "I"), (1, 1, "assistant", "hi.", "K"), (1, 2, "user", "a?", "K"), (1, 3, "assistant", "b.", "K")]
