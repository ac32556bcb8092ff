import json

from caseloom.functions.replies import parse_reply

GOOD = {
    "issue_category": "DAMAGED_ITEM", "sentiment": "NEGATIVE", "urgency": "HIGH",
    "requires_human_followup": True, "root_cause_hint": "packaging", "pii_redacted_message": "x",
    "customer_summary": "Broken mug.", "next_best_action": "Replace it",
}


def _parse(spark, replies):
    df = spark.createDataFrame([(str(i), r) for i, r in enumerate(replies)], "id string, reply string")
    return {r.id: r for r in parse_reply(df, "reply").collect()}


def test_fences_and_blanks(spark):
    body = json.dumps(GOOD)
    variants = [body, f"```json\n{body}\n```", f"```JSON {body}```", f"```\n{body}\n```", f"  \n{body}\n\t ",
                f"```json\n{body}\n```   \n"]
    out = _parse(spark, variants)
    for r in out.values():
        assert r.reply_error is None, r
        assert r.issue_category == "DAMAGED_ITEM" and r.requires_human_followup is True and r.enum_ok


def test_bad_replies_are_kept_with_a_reason(spark):
    missing = dict(GOOD)
    del missing["urgency"]
    extra = dict(GOOD, confidence=0.9)
    unknown = dict(GOOD, issue_category="LOST_PARCEL")
    as_text = dict(GOOD, requires_human_followup="true")
    out = _parse(spark, ["Here you go: " + json.dumps(GOOD), json.dumps(missing), json.dumps(extra),
                         json.dumps(unknown), json.dumps(as_text), None])
    assert out["0"].reply_error == "unparseable reply" and out["0"].issue_category is None
    assert out["1"].reply_error == "missing keys: urgency" and out["1"].issue_category == "DAMAGED_ITEM"
    assert out["2"].reply_error is None and out["2"].enum_ok
    assert out["3"].reply_error is None and out["3"].enum_ok is False and out["3"].issue_category == "LOST_PARCEL"
    assert out["4"].requires_human_followup is True and out["4"].enum_ok
    assert out["5"].reply_error == "no reply"


def python_clean(raw):
    """Expected cleaning: trim; a leading ```json (any case) goes, then a
    leading ```, then a trailing ```; trim after each step."""
    text = raw.strip()
    if text[:7].lower() == "```json":
        text = text[7:].strip()
    if text.startswith("```"):
        text = text[3:].strip()
    if text.endswith("```"):
        text = text[:-3].strip()
    return text


def test_strip_fences_fuzz(spark):
    import random

    from pyspark.sql import functions as F

    from caseloom.functions.replies import strip_fences

    rng = random.Random(3)
    heads = ["", "```json", "```JSON", "```Json", "```", "``````json", " ```json\n", "json"]
    tails = ["", "```", "\n```", "``````", "``` \n", "`"]
    spaces = ["", " ", "\n", "\t", " \n\t ", " "]
    body = '{"a": 1}'
    texts = [rng.choice(spaces) + rng.choice(heads) + rng.choice(spaces) + body + rng.choice(spaces)
             + rng.choice(tails) + rng.choice(spaces) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", strip_fences(F.col("t")).alias("c")).collect()}
    bad = [(t, got[i], python_clean(t)) for i, t in enumerate(texts) if got[i] != python_clean(t)]
    assert not bad, bad[:3]


def test_a_reply_is_stripped_and_read_once(spark):
    """Every step has one place in the plan, however many fields are selected; a condition brings one more copy of it."""
    df = spark.createDataFrame([("1", "{}")], "id string, reply string")

    def count(out, what):
        return out._jdf.queryExecution().executedPlan().toString().count(what)

    whole = parse_reply(df, "reply")
    assert count(whole, "from_json(ArrayType(StructType") <= 1 and count(whole, "(from_json(") + count(whole, " from_json(") <= 4
    assert len(whole._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    some = whole.where("enum_ok and reply_error is null").select("id", "sentiment", "urgency")
    assert len(some._jdf.queryExecution().optimizedPlan().toString()) < 4 * len(whole._jdf.queryExecution().optimizedPlan().toString())
