"""Learned replies: counts and gradient rounds against plain numpy, accuracy on held-out tickets, odd rows."""

import hashlib
import json
import re

import numpy as np
from pyspark.sql import functions as F

from caseloom.functions.replies import parse_reply
from caseloom.operators import learn
from caseloom.operators.enrich import enrich
from caseloom.plans import queries
from caseloom.schemas import ENRICHMENT_COLUMNS, ISSUE_CATEGORIES, SENTIMENTS, URGENCIES

TICKET = "ticket_id string, order_id string, customer_id string, created_at timestamp, channel string, customer_message string, agent_notes string"
SLOTS = 256
SAID = ["Where is my parcel, it is late", "The mug is broken. Please help!", "Refund not received; call 9876543210", None, "", "Wrong colour sent"]


def stored(n):
    out = []
    for i in range(n):
        kind = i % 5
        reply = {"issue_category": ISSUE_CATEGORIES[kind], "sentiment": SENTIMENTS[i % 3], "urgency": URGENCIES[kind % 3],
                 "requires_human_followup": kind > 2, "root_cause_hint": f"cause {kind} {'rare' if i % 7 == 0 else 'usual'}", "pii_redacted_message": "m",
                 "customer_summary": "s", "next_best_action": f"do {kind}"}
        text = json.dumps(reply) if i % 11 else "no reply at all"
        out.append((f"T{i}", f"O{i}", f"C{i}", None, "WEB", f"{SAID[kind] or ''} number 1234567", f"kind{kind} mood{i % 3}" if i % 4 else None, text))
    return out


def replies(spark, n=300):
    return parse_reply(spark.createDataFrame(stored(n), TICKET + ", reply string"), "reply")


def slots_of(message, notes):
    out = set()
    for origin, text in (("m:", message), ("n:", notes)):
        for t in re.findall(r"[^\W_]+", (text or "").lower()):
            if not re.fullmatch("[0-9]{5,}", t):
                out.add(int(hashlib.md5((origin + t).encode()).hexdigest()[:8], 16) % SLOTS)
    return out


def plain(rows, rounds, rate):
    """Counting and full-batch AdaGrad with dense matrices."""
    x, y = [], []
    for tid, _, _, _, _, message, notes, text in rows:
        if int(hashlib.md5(tid.encode()).hexdigest()[:4], 16) % 5 == 0 or not text.startswith("{"):
            continue
        r = json.loads(text)
        row = np.zeros(SLOTS + 1)
        row[list(slots_of(message, notes))] = 1
        row[-1] = 1
        hot = np.zeros(learn.OUTPUTS)
        for head, values in learn.HEADS.items():
            v = r[head]
            hot[learn.FIRST[head] + values.index(str(v).lower() if isinstance(v, bool) else v)] = 1
        x.append(row)
        y.append(hot)
    x, y = np.array(x), np.array(y)
    counts = x.T @ y
    n = y.sum(axis=0)
    w = np.log((counts + 1) / (n + 2))
    for head, values in learn.HEADS.items():
        part = slice(learn.FIRST[head], learn.FIRST[head] + len(values))
        w[-1, part] = np.log((n[part] + 1) / (n[part].sum() + len(values)))
    for head, values in learn.HEADS.items() if rounds else ():
        part = slice(learn.FIRST[head], learn.FIRST[head] + len(values))
        w[:-1, part] -= w[:-1, part].mean(axis=1, keepdims=True)
    square = np.zeros_like(w)
    for _ in range(rounds):
        logits = x @ w
        p = np.zeros_like(logits)
        for head, values in learn.HEADS.items():
            part = slice(learn.FIRST[head], learn.FIRST[head] + len(values))
            e = np.exp(logits[:, part] - logits[:, part].max(axis=1, keepdims=True))
            p[:, part] = e / e.sum(axis=1, keepdims=True)
        g = x.T @ (p - y) / len(x)
        g[:-1] += 3e-3 * w[:-1]
        square += g * g
        w -= rate * g / np.sqrt(square + 1e-12)
    return w


def test_counts_and_rounds_equal_plain_numpy(spark):
    for rounds in (0, 6):
        model = learn.fit(replies(spark), rounds=rounds, batches=1, slots=SLOTS)
        assert np.abs(model.weights / learn.SCALE - plain(stored(300), rounds, 0.3)).max() < 1e-5


def test_training_files_do_not_stay(spark):
    import glob

    from caseloom.config import checkpoint_dir

    mine = f"{checkpoint_dir(spark).removeprefix('file:')}/reply-training-*"
    before = set(glob.glob(mine))
    learn.fit(replies(spark, 40), rounds=1, slots=SLOTS)
    assert set(glob.glob(mine)) <= before


def test_scores_are_exact_sums(spark):
    model = learn.fit(replies(spark), rounds=2, slots=SLOTS)
    rows = [(f"Q{i}", "o", "c", None, "WEB", m, n) for i, (m, n) in enumerate((m, n) for m in SAID for n in (None, "kind1 mood2", ""))]
    got = learn.predict(spark.createDataFrame(rows, TICKET).withColumn("sentiment", F.lit("clash")), model).collect()
    assert len(got) == len(rows)
    for r in got:
        s = model.weights[-1] + model.weights[sorted(slots_of(r.customer_message, r.agent_notes))].sum(axis=0)
        for head, values in learn.HEADS.items():
            part = s[learn.FIRST[head]:learn.FIRST[head] + len(values)]
            assert (r[head], r[f"{head}_score"]) == (values[int(part.argmax())], int(part.max()))


def test_learned_replies_beat_the_rules_on_held_out_tickets(spark):
    got = {(r["head"], r["method"]): (r.n, r.right) for r in queries.learned_reply_accuracy(spark, "/root/testdata/sf0.01").collect()}
    n, right = got["issue_category", "learned"]
    assert n > 1000 and right / n > 0.95 and got["issue_category", "rules"][1] / n < 0.3
    assert got["sentiment", "learned"][1] / n > 0.95 > got["sentiment", "rules"][1] / n
    for head in ("urgency", "requires_human_followup"):  # the text doesn't tell them: the most frequent value
        assert got[head, "learned"][1] >= got[head, "rules"][1] - 0.01 * n


def test_rounds_improve_on_counting(spark):
    rows = queries.stored_replies(spark, "/root/testdata/sf0.001")
    tickets = queries.silver_tickets(spark, "/root/testdata/sf0.001")
    right = {}
    for rounds in (0, 24):
        out = learn.accuracy(rows, {"m": learn.predict(tickets, learn.fit(rows, rounds=rounds))}).collect()
        right[rounds] = sum(r.right for r in out)
    assert right[24] >= right[0]


def test_enrich_with_a_model(spark, workdir):
    model = learn.fit(replies(spark), slots=SLOTS)
    model.save(spark, f"{workdir}/model")
    again = learn.ReplyModel.load(spark, f"{workdir}/model")
    assert np.array_equal(again.weights, model.weights) and again.usual == model.usual
    rows = [("Q1", "O9", "c", None, "WEB", "Hello there. The mug is broken, mail me at a.b@c.com! Bye.", "kind1"), ("Q2", None, None, None, None, None, None),
            ("Q3", "O1", "c", None, "WEB", "", ""), ("Q4", "O2", "c", None, "WEB", "word " * 40000 + ".", None)]
    got = {r.ticket_id: r for r in enrich(spark.createDataFrame(rows, TICKET), model=again).collect()}
    assert len(got) == 4 and list(got["Q1"].asDict()) == [*ENRICHMENT_COLUMNS, "reply_error", "enum_ok"]
    one = got["Q1"]
    assert (one.issue_category, one.next_best_action, one.root_cause_hint) == (ISSUE_CATEGORIES[1], "do 1", "cause 1 usual")
    assert one.customer_summary == 'Damaged Item on order O9: "The mug is broken, mail me at [REDACTED_EMAIL]!"'
    assert "a.b@c.com" not in one.pii_redacted_message and one.enum_ok and one.reply_error is None
    assert got["Q2"].customer_summary.endswith(" on order unknown.") and got["Q2"].pii_redacted_message is None


def test_nothing_to_learn_from(spark):
    empty = replies(spark).limit(0)
    model = learn.fit(empty, slots=SLOTS)
    assert set(model.usual.values()) == {(None, None)}
    tickets = spark.createDataFrame([("Q1", "O9", "c", None, "WEB", "x", "y")], TICKET)
    assert enrich(tickets, model=model).count() == 1 and enrich(tickets.limit(0), model=model).collect() == []
    bad = parse_reply(spark.createDataFrame([(*r[:7], "junk") for r in stored(10)], TICKET + ", reply string"), "reply")
    assert np.array_equal(learn.fit(bad, slots=SLOTS).weights, model.weights)
