"""op5 against a plain recomputation, and its chunks and slots under hot rows."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ingot.llm import toxicity
from tests.llm.test_operators import SF, alnum


def held(doc):
    return zlib.crc32(str(doc).encode()) % 4 == 2


def counts_of(texts):
    """Bigrams, and what the models take from them, of (text, toxic) by plain counting."""
    pairs = [Counter(), Counter()]
    for text, y in texts:
        w = alnum(text)
        pairs[y].update(zip([None] + w, w))
    m = {"pairs": pairs, "a": [Counter(), Counter()], "b": [Counter(), Counter()], "t": [Counter(), Counter()], "s": [Counter(), Counter()]}
    for y in (0, 1):
        for (v, w), n in pairs[y].items():
            m["a"][y][v] += n
            m["b"][y][v] += 1
            m["t"][y][w] += 1
            m["s"][y][w.encode()[:4]] += 1
    m["words"] = len(set(m["t"][0]) | set(m["t"][1]))
    m["stems"] = len(set(m["s"][0]) | set(m["s"][1]))
    return m


def ratio(m, v, w):
    d, prior, stem = toxicity.DISCOUNT, toxicity.PRIOR, w.encode()[:4]
    types = [len(m["pairs"][y]) for y in (0, 1)]
    stems = m["s"][0][stem] + m["s"][1][stem]
    shared = (stems + 0.5) / (sum(types) + 0.5 * (m["stems"] + 1))
    known = m["t"][0][w] + m["t"][1][w]
    within = min((known + 0.5) / (stems + 1), 1) if known else 0.5 / (1 + m["words"])
    p = []
    for y in (0, 1):
        low = max(m["s"][y][stem] - d, 0) / types[y] + d * len(m["s"][y]) / types[y] * shared
        mid = max(m["t"][y][w] - d, 0) / types[y] + d * len(m["t"][y]) / types[y] * low * within
        p.append((mid * (d * m["b"][y][v] + prior) + max(m["pairs"][y][v, w] - d, 0)) / (m["a"][y][v] + prior))
    return math.log(p[1] / p[0])


def evidence(m, text):
    w = alnum(text)
    r = [ratio(m, a, b) for a, b in zip([None] + w, w)]
    if not r:
        return [0.0] * 4
    whole = sum(min(max(x, -toxicity.CLEAR), 3 * toxicity.CLEAR) for x in r) / len(r)
    k = toxicity.WINDOW
    window = max(sum(r[i:i + k]) / k for i in range(len(r) - k + 1)) if len(r) >= k else whole
    clear = [x - toxicity.CLEAR for x in r if x > toxicity.CLEAR]
    return [whole, window, sum(clear) / len(r), len(clear) / len(r)]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_scores_by_brute_force(tables):
    docs, labels = tables
    unseen = {r.doc_id: r.u for r in docs.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0).alias("u")).collect()}
    of = defaultdict(int)
    for r in labels.collect():
        if r.toxic is not None and not held(r.doc_id):
            of[r.doc_id] = max(of[r.doc_id], r.toxic)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    m = counts_of([(t, of[d]) for d, t in texts if d in of and not unseen[d]])
    x = {d: evidence(m, t) for d, t in texts}
    fit = [d for d, _ in texts if d in of and unseen[d]]
    y, share = np.array([of[d] for d in fit], float), sum(of.values()) / len(of)
    assert 0 < y.sum() < len(y)
    weight = np.where(y == 1, share * len(y) / y.sum(), (1 - share) * len(y) / (len(y) - y.sum()))
    beta = toxicity.logistic(np.array([x[d] for d in fit]), y, weight)
    want = {d: 1 / (1 + math.exp(-(sum(a * b for a, b in zip(x[d], beta)) + beta[-1]))) for d in x}
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert {d: r.score for d, r in got.items()} == pytest.approx(want, rel=1e-6, abs=1e-9)
    assert all(r.held_out == held(d) and r.predicted == (r.score >= 0.3) for d, r in got.items())


def hot(docs):
    """A third of the rows equal, without doc_id, and as many without a text."""
    n = docs.count() // 2
    one = docs.orderBy("doc_id").limit(1).select(F.lit(None).cast("long").alias("doc_id"), "text")
    return docs.select("doc_id", "text").unionByName(one.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("k")).unionByName(
        one.withColumn("text", F.lit(None).cast("string")).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("k"))


def test_chunks_are_bounded_and_whole(tables, monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK", 20_000)
    docs = hot(tables[0])
    chunks = toxicity.chunked(docs, ["doc_id", "text"], "text").collect()
    parts = [toxicity.pa.ipc.open_stream(bytes(r.rows)).read_all().to_pylist() for r in chunks]
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")
    assert sorted((r for p in parts for r in p), key=key) == sorted((r.asDict() for r in docs.collect()), key=key)
    assert len({r.chunk for r in chunks}) == len(chunks) > 10
    assert all(len(p) == 1 or sum(len((r["text"] or "").encode()) + toxicity.ROW for r in p) <= 20_000 for p in parts)


def test_copies_of_slots_change_no_score(tables, monkeypatch):
    docs, labels = hot(tables[0]), tables[1]
    scores = lambda: sorted(((r.doc_id is None, r.doc_id or 0), round(r.score, 9)) for r in toxicity.toxicity(docs, labels).collect())
    one = scores()
    monkeypatch.setattr(toxicity, "CHUNK", 2_000)
    monkeypatch.setattr(toxicity, "SHARE", 5_000)
    assert scores() == one


def test_setting_is_put_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(KeyError), toxicity.short_shuffles(spark):
        assert spark.conf.get(name) == "true"
        raise KeyError
    assert spark.conf.get(name) == before
