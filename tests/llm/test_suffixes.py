import hashlib
import random

import numpy as np
import pytest

from ingot.llm.gsaca import suffix_order
from ingot.llm.suffixes import dedup


def test_suffix_order_against_sorting():
    rng = np.random.default_rng(0)
    for _ in range(600):
        s = rng.integers(0, rng.integers(1, 5), rng.integers(0, 40))
        assert suffix_order(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def brute(rows, length=100):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        b = (text or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            x = b[i:i + length]
            if x in seen:
                gone[i:i + length] = [True] * length
            seen.add(x)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 6)))
    line = lambda n: " ".join(word() for _ in range(n))
    passages = [line(k) for k in (15, 20, 25, 40, 60)]
    base = line(300)
    rows = [(i, line(rnd.randint(0, 60)) + rnd.choice(["", " "]) + rnd.choice(passages) + line(rnd.randint(0, 40))) for i in range(60)]
    rows += [(100 + i, base) for i in range(8)]
    for i in range(25):
        w = base.split(" ")
        for _ in range(4):
            w[rnd.randrange(len(w))] = word()
        rows.append((200 + i, " ".join(w)))
    rows += [(300, "a" * 450), (301, "ab" * 240), (302, "a" * 130), (303, base + base), (304, None), (305, ""), (306, "x" * 99),
             (307, passages[4][:100]), (308, passages[4][:100]), (309, passages[4][:101]), (None, passages[3]), (None, base), (303, passages[2]), (303, base + base)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"hot": 2}, {"chunk_bytes": 3000}])
def test_dedup_against_brute_force(spark, options):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, chunk string").repartition(3)
    got = sorted(map(tuple, dedup(df, **options).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark):
    assert dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
