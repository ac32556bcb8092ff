"""Buckets that hold too many windows are cut: the same rows, and no large group."""

import random
import re

import pytest

from caseloom.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts():
    rng = random.Random(7)
    line = " ".join(f"line{k}" for k in range(12))
    own = [f"{' '.join(rng.choice('abcdefgh') + str(rng.randrange(40)) for _ in range(25))}" for _ in range(40)]
    rows = [f"{rng.choice(own)} {line} {rng.choice(own)}" for _ in range(300)]  # one line, different and equal surroundings
    return rows + [line, line * 3, "", None, "x " * 300, rows[0], rows[5] + " " + rows[9]]


def expected(rows):
    seen, out = set(), []
    for text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k:k + 20])
            if window in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(window)
        out.append((len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


@pytest.mark.parametrize("bucket_windows", [1, 50, 1 << 18])
def test_cut_buckets_give_the_same_rows(spark, bucket_windows):
    rows = texts()
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(3)
    got = substrings.dedup_substrings(df, with_text=True, bucket_windows=bucket_windows).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept_text) for r in got] == expected(rows)


def test_no_group_stays_large(spark):
    rows = [(i, t) for i, t in enumerate(texts()) if t]
    df = spark.createDataFrame(rows, "at bigint, text string")
    parts = substrings.parts_of_bins(df.select("text"), 20, 6, 100)
    assert (parts > 1).any()

    def windows(parts):
        out = {}
        for r in df.mapInArrow(lambda b: substrings._pieces(b, 20, 6, parts), "bucket long, at long, piece binary").collect():
            out.setdefault(r.bucket, []).append((len(r.piece) - 4) // 8)
        return out

    import numpy as np
    before, after = windows(np.ones(1 << 14, np.int64)), windows(parts)
    copies = sum(n == 0 for ns in after.values() for n in ns)
    assert sum(map(sum, after.values())) + copies == sum(map(sum, before.values())) and copies > 0
    assert max(map(sum, before.values())) > 200 and max(map(sum, after.values())) <= 125  # 100 a part, dealt by hash
