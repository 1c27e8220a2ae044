"""Every operator against a brute-force version, on odd rows and on the smallest tables."""

import functools
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ingot.llm import counts, decontaminate, exact, mixing, neardup, sharding, tokens, toxicity, urls
from ingot.llm.common import components

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = "_scan string, _score double, score string, _mix int, _size int, _rate int, _copies int, _dropped long, component_id long, part int, size string, _block int, _group string, _parts int"


def odd_rows():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abdeéstZ0") for _ in range(rnd.randint(1, 7)))
    line = lambda n: " ".join(word() for _ in range(n))
    base, short = line(120), line(7)
    rows = [(i, line(rnd.randint(0, 50)), "s%d" % (i % 4)) for i in range(40)]
    for i in range(30):
        w = base.split(" ")
        for _ in range(i % 4):
            w[rnd.randrange(len(w))] = word()
        rows.append((100 + i, " ".join(w), "s1"))
    rows += [(200 + i, short + " " * i, "hot") for i in range(12)]
    rows += [(300, None, "s1"), (301, "", None), (302, " \t\n ", "s2"), (303, "one", "s2"), (304, "ONE", "s2"), (305, "one two Three four", None),
             (306, line(20_000), "s3"), (307, "x" * 50_000, "s3"), (None, base, "s1"), (None, None, None), (300, None, "s1"),
             (100, rows[40][1], "s1"), (100, rows[40][1], "s1"), (308, "Ünïcode \u3000 \x00 words <|endoftext|> it's 𝒳", "é")]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    blank = tuple(None for _ in CLASHING.split(", "))
    return spark.createDataFrame([r + blank for r in odd_rows()], f"doc_id long, text string, source string, {CLASHING}").repartition(3).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def same(got, expected):
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, expected), key=str)


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def solid(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


# -- 1

def contaminated(docs, items, n=10):
    out = []
    grams = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        k = min(n, len(w))
        for i in range(len(w) - k + 1) if k else ():
            grams[tuple(w[i:i + k])].add("" if item is None else str(item))
    sizes = {len(g) for g in grams}
    for doc, text in docs:
        w, hit, found = alnum(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if g := grams.get(tuple(w[i:i + k])):
                    hit |= set(range(i, i + k))
                    found |= g
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_decontamination(spark, odd, none, block):
    rows = odd_rows()
    long_ = next(t for d, t, _ in rows if d == 306)
    items = [(1, " ".join(long_.split(" ")[500:530]).upper()), (2, "three, FOUR"), (3, None), (4, "..."), (None, "one"), (10, "one"), (10, "one"),
             (11, next(t for d, t, _ in rows if d == 100)), (12, "not in there at all really no")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    same(decontaminate.contamination(odd, bench, block_bytes=block).collect(), contaminated([r[:2] for r in rows], items))
    assert decontaminate.contamination(none, bench).collect() == []
    assert {r.contaminated for r in decontaminate.contamination(odd, bench.where("false")).collect()} == {False}
    kept = decontaminate.decontaminate(odd, bench)
    assert kept.columns == odd.columns
    clean = Counter(d for d, *_, c in contaminated([r[:2] for r in rows], items) if not c)
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == clean
    cut = decontaminate.decontaminate(odd, bench, mode="spans")
    assert cut.count() == len(rows) and next(r.text for r in cut.where("doc_id = 305").collect()) == "two"


# -- 3

def test_tokens(spark, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    t = Tokenizer.from_file(path)
    base, manifest = tokens.write_shards(odd, path, 49408, 1)
    got = sorted(map(tuple, tokens.read_shards(spark, base, manifest).collect()), key=lambda r: r[1])
    start, by_id, expected = 0, defaultdict(list), []
    for doc, text, _ in sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        by_id[doc].append(ids)
        start += len(ids)
    assert got == expected
    keys = spark.createDataFrame([(k,) for k in [*by_id, 10**12, -5, 99, 309]], "doc_id long")
    found = defaultdict(list)
    for r in tokens.fetch(keys, base, manifest).collect():
        found[r.doc_id].append(list(r.ids))
    assert dict(found) == {k: v for k, v in by_id.items() if k is not None}
    name = manifest.orderBy("part").first()["name"]
    assert [x.tolist() for x in tokens.Shard(base, name).get(None)] == by_id[None]
    assert tokens.token_table(none).collect() == []


def test_perfect_hash():
    h = tokens.mix64(np.arange(5000, dtype=np.uint64))
    p = tokens.PerfectHash.build(h)
    assert sorted(p.slots(h).tolist()) == list(range(5000))
    assert tokens.PerfectHash.build(h[:0]).slots(h[:3]).tolist() == [-1] * 3


# -- 4

def test_mixing(spark, odd, none):
    got = [tuple(r) for r in mixing.mixture(odd).collect()]
    again = [tuple(r) for r in mixing.mixture(odd.repartition(5)).collect()]
    same(got, again)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = Counter()
    for _, t, s in odd_rows():
        by[s] += size(t)
    targets = mixing.shares(list(by.items()))
    assert math.isclose(sum(targets.values()), sum(by.values())) and all(t <= 3 * by[s] + 1e-9 for s, t in targets.items())
    assert list(sorted(by, key=lambda s: (s is None, s or "")))[-1] is None
    own = {(d, size(t)): s for d, t, s in odd_rows()}
    taken = Counter()
    for d, n, total, target, words, copies in got:
        s = own[d, n]
        assert (total, target) == (by[s], targets[s]) and words == n * copies <= 3 * n
        taken[s] += words
    assert all(abs(taken[s] - targets[s]) <= 0.05 * targets[s] + 40 for s in by if s != "s3")
    out = mixing.resampled(odd)
    assert out.columns == odd.columns and Counter(r.doc_id for r in out.select("doc_id").collect()) == Counter(
        {k: v for k, v in Counter(d for d, *_, c in got for _ in range(c)).items()})
    assert mixing.mixture(none).collect() == [] and mixing.resampled(none).collect() == []


def test_shares_by_hand():
    # all 100; weights 5, 2, 1, 5: a stops at 3 * 10, the rest goes 2:1:5
    assert mixing.shares([("a", 10), ("b", 50), ("c", 30), (None, 10)]) == {"a": 30.0, "b": 40 / 3 * 2, "c": 40 / 3, None: 30.0}


def test_newton_meets_two_margins(spark):
    cells = spark.createDataFrame([(a, b, 10 * (i + 1) + 7 * j) for i, a in enumerate("xyz") for j, b in enumerate("pq")], "a string, b string, size long")
    want = {"a": {"x": 30.0, "y": 60.0, "z": 50.0}, "b": {"p": 100.0, "q": 40.0}}
    lam = mixing.newton(cells, want)
    sums = {"a": Counter(), "b": Counter()}
    for r in cells.collect():
        m = r["size"] * math.exp(lam["a"][r.a] + lam["b"][r.b])
        sums["a"][r.a] += m
        sums["b"][r.b] += m
    assert all(math.isclose(sums[c][v], t, rel_tol=1e-6) for c in want for v, t in want[c].items())


# -- 5

def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    rank, y = got.score.rank(), got.toxic == 1
    auc = (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    assert auc > 0.93 and got.predicted.equals((got.score >= 0.3).astype("int32")) and got.score.between(0, 1).all()
    assert got.held_out.all() and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id)
    # labels of held-out rows, and other columns, change nothing
    from pyspark.sql import functions as F
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    a = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.toxicity(other, flipped).collect()}
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k], rel_tol=1e-6, abs_tol=1e-9) for k in a)


def test_toxicity_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)] + [(41, None), (None, 1), (3, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(odd, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, *_ in odd_rows()) and all(0 <= r.score <= 1 for r in got)
    one = toxicity.toxicity(odd, labels.where("toxic = 0")).collect()
    assert {r.score for r in one} == {0.0} and {r.score for r in toxicity.toxicity(odd, labels.where("false")).collect()} == {0.0}
    assert toxicity.toxicity(none, labels).collect() == []
    kept = toxicity.drop_toxic(odd, labels)
    assert kept.columns == odd.columns and kept.count() == sum(r.score < 0.3 for r in got)


def test_toxicity_counts_all_learnable_rows(spark):
    rows = [(i, ("vile " if i % 2 else "kind ") + f"zq{i} xw{i}", i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    # a word and a pair of a single learnable row have a say, whatever max_rows is
    seen = {r.doc_id for r in docs.where("pmod(xxhash64(doc_id, 1), 4) != 0").collect()} - {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2}
    new = spark.createDataFrame([(1000 + i, f"zq{i} xw{i}") for i in sorted(seen)], "doc_id long, text string")
    got = {r.doc_id - 1000: r.score for r in toxicity.toxicity(docs.unionByName(new), labels, max_rows=20).where("doc_id >= 1000").collect()}
    assert len(got) == len(seen) > 200 and min(got[i] for i in seen if i % 2) > max(got[i] for i in seen if not i % 2)


def test_toxicity_counts_keep_every_pair_and_word(spark, monkeypatch):
    texts = [("a b c a b", 1), ("A b d", 0), (None, 1), ("", 0), ("rare", 1)] + [(f"w{i} w{i + 1}", i % 2) for i in range(50)]
    want, words = Counter(), set()
    for text, y in texts:
        w = alnum(text)
        want.update((a, b, y) for a, b in zip([""] + w, w))
        words.update(w)
    for rounds in (1, 3):
        parts = [toxicity.counted(spark.createDataFrame(texts, "text string, toxic int"), rounds, k).cache() for k in range(rounds)]
        rows = [r for p in parts for r in p.collect()]
        assert sum(r.n1 + r.n0 > 0 for r in rows) == len({k[:2] for k in want}) and sum(r.n1 + r.n0 for r in rows) == sum(want.values())
        model = toxicity.KneserNey(toxicity.written(functools.reduce(lambda a, b: a.unionByName(b), parts), "test-bigrams"))
        assert model.words == len(words) and {r.k: r.n for r in model.table.selectExpr(f"slot div {model.n} k", "n").groupBy("k").sum("n").toDF("k", "n").collect()} == {
            toxicity.PAIR: len({k[:2] for k in want}), toxicity.WORD: len(words) + 1, toxicity.STEM: len({w[:4] for w in words})}
    # and rounds change no score
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    one = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    monkeypatch.setattr(toxicity, "LARGE", 0)
    assert one == pytest.approx({r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()})


# -- 6

def exact_rows(rows):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc, len(text or "")))
    for content, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        for doc, _ in members:
            yield doc, keep, len(members), doc == keep, hashlib.sha256(content.encode()).hexdigest()


@pytest.mark.parametrize("budget", [48 << 20, 500])
def test_exact(odd, none, budget):
    same(exact.exact_duplicates(odd, budget=budget).collect(), exact_rows(odd_rows()))
    assert exact.exact_duplicates(none).collect() == []
    kept = exact.keep_one(odd)
    gone = {d for d, k, *_ in exact_rows(odd_rows()) if d is not None and d != k}
    assert kept.columns == odd.columns and {r.doc_id for r in kept.select("doc_id").collect()} == {d for d, *_ in odd_rows()} - gone


def test_grace_spills_and_cleans_up(tmp_path):
    rnd = random.Random(1)
    texts = [rnd.choice("abcdefgh") * rnd.randint(1, 60) for _ in range(3000)]
    records = [(hashlib.sha256(t.encode()).digest(), t.encode(), len(t), i, 1) for i, t in enumerate(texts)]
    got = {e[1].decode(): (e[3], e[4]) for e in exact.grace(records, budget=2000, folder=str(tmp_path))}
    assert got == {t: (texts.index(t), n) for t, n in Counter(texts).items()} and list(tmp_path.iterdir()) == []
    with pytest.raises(ValueError, match="different contents"):
        list(exact.grace([(b"\1" * 32, b"x", 1, 1, 1), (b"\1" * 32, b"y", 1, 2, 1)]))


# -- 7

def test_token_counts(odd, none):
    import public_tokenizers

    scores = counts.piece_scores(str(public_tokenizers.path("piece_bpe_32k.model")))
    low, longest = min(scores.values()) - 10.0, max(map(len, scores))

    def plain(word):
        x, best = counts.MARK + word, [(0.0, 0)]
        for j in range(1, len(x) + 1):
            n = len(x[j - 1].encode())
            options = [(best[j - 1][0] + n * low, best[j - 1][1] + n)]
            options += [(best[i][0] + scores[x[i:j]], best[i][1] + 1) for i in range(max(0, j - longest), j) if x[i:j] in scores]
            top = max(o[0] for o in options)
            best.append(min((o for o in options if abs(o[0] - top) < 1e-9), key=lambda o: o[1]))
        return best[-1][1]

    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    rows = [r for r in odd_rows() if r[0] != 307]
    expected = [(d, len(words(t)), sum(map(plain, words(t)))) for d, t, _ in rows]
    same(counts.token_counts(odd.where("doc_id IS NULL OR doc_id <> 307")).collect(), expected)
    assert counts.token_counts(none).collect() == []
    trie = counts.Trie(scores)
    assert trie.count("x" * 500) == plain("x" * 500) and len(trie.score) == 1
    assert trie.count("tokens") == plain("tokens") and trie.count("token") == plain("token") and len(trie.score) == 8


# -- 8

def shingles(text, n=5):
    w = solid(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def near(rows, percent=85):
    sets = defaultdict(set)
    for d, t, *_ in rows:
        if d is not None:
            sets[d].add(frozenset(shingles(t)))
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [(d, len(shingles(t)), root(d) if d is not None else None, d is None or root(d) == d) for d, t, *_ in rows]


@pytest.mark.parametrize("weight", [1_500_000, 4000])
def test_near_duplicates(odd, none, weight):
    same(neardup.near_duplicates(odd, block_weight=weight).collect(), near(odd_rows()))
    assert neardup.near_duplicates(none).collect() == []
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d for d, *_, k in near(odd_rows()) if k}


def test_near_duplicates_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    same(neardup.near_duplicates(docs).collect(), near([(r.doc_id, r.text) for r in docs.collect()]))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(50, 40), (60, 50), (60, 60), (70, 71), (71, 70)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {40: 40, 50: 40, 60: 40, 70: 70, 71: 70}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# -- 9

def test_shards(odd, none):
    got = sorted((tuple(r) for r in sharding.shards(odd, 5).collect()), key=lambda r: (r[4], r[5]))
    rows = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, _ in odd_rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
    total, before, expected, slots = sum(r[1] for r in rows), 0, [], Counter()
    for d, n, c in rows:
        k = min(4, (2 * before + n) * 5 // (2 * total))
        expected.append((d, n, c, "bytes", k, slots[k], None))
        slots[k] += 1
        before += n
    assert got == expected and sharding.shards(none).collect() == []


def test_shards_are_near_equal(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = Counter()
    for r in sharding.shards(docs, 24).collect():
        sizes[r.shard] += r.size
    largest = 33_047 + 8
    mean = sum(sizes.values()) / 24
    assert set(sizes) == set(range(24)) and all(abs(n - mean) <= largest for n in sizes.values())
    sharding.write_shards(docs, str(tmp_path / "out"), 24)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 1000 and back.select("shard").distinct().count() == 24


# -- 10

def test_urls(spark):
    cases = {
        "http://a.net/x": ("a.net", "/x", "net/", "block"), "https://EXAMPLE.net/en/1": ("example.net", "/en/1", "example.net/en/", "allow"),
        "http://www.example.com/de/?q": ("www.example.com", "/de/", "example.com/de/", "block"), "http://example.com/fr/": ("example.com", "/fr/", None, "allow"),
        "http://x.org/fr/a#b": ("x.org", "/fr/a", "org/fr/", "allow"), "http://net/": ("net", "/", "net/", "block"), "http://planet/": ("planet", "/", None, "allow"),
        "http://a.net": ("a.net", "", None, "allow"), "http://a.net?x=/": ("a.net", "", None, "allow"), "a.net/x": ("", "", None, "allow"), "": ("", "", None, "allow"),
        None: ("", "", None, "allow"), "://h/p://q": ("h", "/p://q", None, "allow"), "http://free-PORN.com/": ("free-porn.com", "/", None, "block"),
        "http://pornography.com/": ("pornography.com", "/", None, "allow"), "http://a.com/casino": ("a.com", "/casino", None, "allow"),
        "http://a.com/casino-casino": ("a.com", "/casino-casino", None, "allow"), "http://a.com/casino/poker": ("a.com", "/casino/poker", None, "block"),
        "http://casino.org/fr/porn": ("casino.org", "/fr/porn", "org/fr/", "allow"), "http://a.com/xxx": ("a.com", "/xxx", None, "block"), "http://sussex.com/adultery": ("sussex.com", "/adultery", None, "allow"),
    }
    rows = [(i, u, "x") for i, u in enumerate(cases)] + [(None, "http://a.net/", None), (0, "http://a.net/x", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = {r.page_id: tuple(r)[1:5] for r in urls.judge(pages).collect() if r.page_id is not None}
    assert got == {i: v for i, v in enumerate(cases.values())}
    assert urls.judge(pages).count() == len(rows) and urls.judge(pages.where("false")).collect() == []
