import re

import pytest
from pyspark.sql import functions as F

from caseloom.functions.pii import redact

# The masking patterns in Python regex syntax, where \d, \w and
# \b are Unicode-aware; the Spark patterns must give the same answers.
PY_PHONE = r"\b\d{10}\b"
PY_EMAIL = r"[\w\.-]+@[\w\.-]+\.\w+"


def python_redact(text):
    for pattern, token in ((PY_PHONE, "[REDACTED_PHONE]"), (PY_EMAIL, "[REDACTED_EMAIL]")):
        text = re.sub(pattern, token, text)
    return text


CASES = [
    "nothing to hide here",
    "call 9800000044 now",
    "account 980000004412 stays",
    "a_9800000044 stays",
    "+91 9800000044 keeps the prefix",
    "split 98000 00044 stays",
    "two: a.b@x.com and c-d@y.org.in",
    "9800000044@x.com",
    "josé.pérez@correo.es wrote",
    "digits ٩٨٠٠٠٠٠٠٤٤ in Arabic-Indic",
    "9800000044 9800000045 9800000046 adjacent",
    "line\n9800000044\nnext",
    "émile9800000044 glued to a letter",
    "x" * 5000 + "@" + "y" * 5000 + ".com and " + "z" * 20000,
    "a-b.c_d@sub.example.co.uk, e@f.g; h@i",
    ".lead@dot.com -dash@x.io",
    "a@b.cc.-x@y.z",
    "u@v.ww-p@q.rr",
]


@pytest.mark.parametrize("text", CASES)
def test_redact_matches_python_semantics(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(redact(F.col("t")).alias("r")).collect()[0].r
    assert got == python_redact(text)


def test_redact_null(spark):
    got = spark.createDataFrame([(None,)], "t string").select(redact("t").alias("r")).collect()[0].r
    assert got is None


def test_order_of_rules():
    assert python_redact("9800000044@x.com") == "[REDACTED_PHONE]@x.com"


def test_redact_fuzz_against_python(spark):
    """Random texts from digits, letters (some accented), e-mail punctuation
    and spaces: Spark's masking equals Python's on every one."""
    import random

    rng = random.Random(11)
    alphabet = list("0123456789" * 3 + "abcxyzé_ü" + "@@..--" + "  \n" + "٣")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(600)]
    texts += ["".join(rng.choice("0123456789 ") for _ in range(rng.randint(5, 40))) for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.r for r in df.select("i", redact(F.col("t")).alias("r")).collect()}
    bad = [(t, got[i], python_redact(t)) for i, t in enumerate(texts) if got[i] != python_redact(t)]
    assert not bad, bad[:3]


def test_oracle_redaction_matches_python():
    """The DuckDB form used by the oracle (RE2, no look-around) agrees too."""
    import random

    import duckdb

    from caseloom.plans.oracle import redact as sql_redact

    rng = random.Random(5)
    alphabet = list("0123456789" * 3 + "abcxyzé_ü" + "@@..--" + "  \n")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(400)] + CASES
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, s VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    got = dict(con.execute(f"SELECT i, {sql_redact('s')} FROM t").fetchall())
    bad = [(t, got[i], python_redact(t)) for i, t in enumerate(texts) if got[i] != python_redact(t)]
    assert not bad, bad[:3]
