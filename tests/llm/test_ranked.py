"""Ranked search against scoring every document for every item."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from ingot.llm import ranked
from tests.llm.test_operators import alnum, none, odd, odd_rows, same  # noqa: F401


def brute(docs, items, top=10):
    tf = [(d, Counter(alnum(t))) for d, t in docs]
    tf = [(d, c, sum(c.values())) for d, c in tf if c]
    n_docs, total = len(tf), sum(n for *_, n in tf)
    df = Counter(t for _, c, _ in tf for t in c)
    for item, text in set(items):
        terms = set(alnum(text))
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in terms}
        scores = []
        for d, c, n in tf:
            m = 100 - 90 + 90 * n * n_docs // total
            if (s := sum(w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms & c.keys())) > 0:
                scores.append((-s, d is None, d or 0, d))
        for k, (s, _, _, d) in enumerate(sorted(scores)[:top]):
            yield item, k + 1, d, -s


@pytest.mark.parametrize("leaf,block,group,text_bytes", [(32, 1 << 22, 4096, 8 << 20), (2, 300, 5, 400)])
def test_ranked(spark, odd, none, monkeypatch, leaf, block, group, text_bytes):  # noqa: F811
    monkeypatch.setattr(ranked, "LEAF", leaf)
    monkeypatch.setattr(ranked, "BLOCK", block)
    monkeypatch.setattr(ranked, "GROUP", group)
    rows = [r[:2] for r in odd_rows()]
    texts = [t for _, t in rows if t and len(t) < 2000]
    rnd = random.Random(7)
    items = [(i, " ".join(rnd.sample(alnum(rnd.choice(texts)) or ["one"], 1) + rnd.sample(alnum(texts[i]) or ["two"], 1) * 3 + ["Zb0", "x" * (50_000 if i == 9 and leaf == 32 else 9)])) for i in range(25)]
    items += [(50, None), (51, " .,"), (None, "one"), (52, "ONE one two"), (52, "ONE one two"), (52, "three"), (53, texts[45][:300].upper()), (54, "no-such-word-here")]
    bench = spark.createDataFrame([(*x, 1, 2.0) for x in items], "item_id long, text string, rank int, score double")
    items = [x for x in items if x[1]]
    same(ranked.ranked(odd, bench, block_bytes=text_bytes).collect(), brute(rows, items))
    if leaf == 32:
        assert ranked.ranked(none, bench).collect() == [] and ranked.ranked(odd, bench.where("false")).collect() == []
        names = odd.selectExpr("concat('d', doc_id) doc_id", "text")
        got = ranked.ranked(names, bench.where("item_id = 53"), top=3).collect()
        assert [r.rank for r in got] == [1, 2, 3] and all(r.doc_id is None or r.doc_id.startswith("d") for r in got)


def test_bounds_leave_subtrees_out():
    rnd = np.random.default_rng(3)
    rows = [np.unique(np.minimum(rnd.geometric(0.05, 12), 199)) for _ in range(4000)]
    indptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    terms, tf = np.concatenate(rows), rnd.integers(1, 5, indptr[-1])
    m, w = rnd.integers(20, 300, len(rows)), np.arange(1, 201) * 30
    tree = ranked.Tree(indptr, terms, tf, m, 200)
    leaves = sum(c is None for c in tree.children)
    for k in range(20):
        mine = np.sort(rnd.choice(120, 6, replace=False))
        place = np.full(200, -1)
        place[mine] = np.arange(6)
        best = []
        read = tree.walk(mine, w[mine], place, best, 10, list(range(len(rows))))
        full = [sum(int(w[t]) * (10**9 * int(f) // (1000 * int(f) + 8 * int(m[d]))) for t, f in zip(terms[indptr[d]:indptr[d + 1]], tf[indptr[d]:indptr[d + 1]]) if t in mine) for d in range(len(rows))]
        want = sorted(((-s, d) for d, s in enumerate(full) if s > 0))[:10]
        assert sorted((-s, d.id) for s, d in best) == want and read < leaves


def test_long_texts(spark):
    """Texts over a megabyte, with terms of more than eight bytes that differ in their last."""
    long = " ".join(f"filler{i % 5000}" for i in range(120_000))
    rows = [(1, long + " internationalization"), (2, "internationalizatioN " + long), (3, long + " internationalizatiox"), (4, "internationalization")]
    df, items = spark.createDataFrame(rows, "doc_id long, text string"), [(1, "internationalization"), (2, "internationalizatiox filler7")]
    same(ranked.ranked(df, spark.createDataFrame(items, "item_id long, text string")).collect(), brute(rows, items))
