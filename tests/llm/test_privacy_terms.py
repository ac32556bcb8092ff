"""Disclosing terms against plain Python counts, also where a value touches letters and where a text is a log."""

import random
import re
from collections import Counter
from math import log2

import pytest

from caseloom.llm import privacy
from test_operators import KINDS, luhn

TERM = re.compile(r"[^\W_]+")


def spans_of(text):
    ok = {"email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
          "card": lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
          "phone": lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15}
    return sorted((m.start(), i, m.end()) for i, (k, p) in enumerate(KINDS) for m in re.finditer(p, text) if ok[k](m[0]))


def masked(text):
    out = list(text)
    for a, _, b in spans_of(text):
        out[a:b] = " " * (b - a)
    return "".join(out)


def expected(texts):
    """For each text its spans as the operator lists them."""
    different = set(texts)
    total, rest = len(different), {t: masked(t) for t in different}
    entities = {t: {(k, t[a:b].lower()) for a, k, b in spans_of(t)} for t in different}
    terms = {t: set(TERM.findall(rest[t].lower())) for t in different}
    with_entity = Counter(e for t in different for e in entities[t])
    with_term = Counter(w for t in different for w in terms[t])
    both = Counter((e, w) for t in different for e in entities[t] if 1 < with_entity[e] < total for w in terms[t])
    told = {(e, w) for (e, w), n in both.items() if n >= 2 and log2(total * n / (with_term[w] * with_entity[e])) / log2(total / with_entity[e]) >= 0.8}
    out = []
    for t in texts:
        telling = {w for e, w in told if e in entities[t]}
        listed = spans_of(t) + [(m.start(), 4, m.end()) for m in TERM.finditer(rest[t]) if m[0].lower() in telling]
        out.append(",".join(f"{('email', 'ip', 'card', 'phone', 'term')[k]}:{a}:{b}" for a, k, b in sorted(listed)))
    return out


def detected(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r.spans for r in privacy.detect(df).orderBy("doc_id").collect()]


def test_values_that_touch_letters(spark):
    texts = ["ip10.0.0.1 a", "ip10.0.0.1 b", "write ip@x.com"]
    assert detected(spark, texts) == expected(texts)
    assert [r.text for r in privacy.sanitise(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")).orderBy("doc_id").collect()]


@pytest.mark.parametrize("seed", range(3))
def test_terms_equal_plain_counts(spark, seed):
    rng = random.Random(seed)
    values = ["10.0.0.1", "ip10.0.0.1", "10.0.0.1x", "kim@a.com", "KIM@a.com", "x+4915112345678", "4111111111111111", "lee@b.org", "no"]
    words = ["ip", "x", "Kim", "kim", "com", "a", "b", "note", "ann", "9", "éa", *[f"w{i}" for i in range(12)]]
    texts = [" ".join(rng.choice(values if rng.random() < 0.25 else words) for _ in range(rng.randrange(9))) for _ in range(150)]
    texts += rng.choices(texts, k=30)
    assert detected(spark, texts) == expected(texts)


def test_a_log_of_many_values_is_not_paired_with_all_its_terms(spark, monkeypatch):
    """Addresses that two long logs share, with thousands of terms that all texts use: no term is paired."""
    common = [f"t{i}" for i in range(400)]
    addresses = " ".join(f"10.{i // 200}.{i % 200}.7" for i in range(300))
    texts = [f"{addresses} {' '.join(common)} own{i}" for i in range(2)] + [" ".join(common) + f" other{i}" for i in range(60)]
    sizes, cut = [], privacy.cut
    monkeypatch.setattr(privacy, "cut", lambda df: sizes.append(cut(df)) or sizes[-1])
    assert detected(spark, texts) == expected(texts)
    assert sizes[-1].columns[:2] == ["at", "term"] and sizes[-1].count() == 0  # 2 x 300 x 401 pairs otherwise
