"""MinHash near-dedup with odd sketches.

1. One map pass makes each document's set of distinct word shingles (64-bit hashes), a digest
   of the set, ``BANDS * ROWS`` MinHash samples as band keys, and an odd sketch: a bitmap in
   which every sample flips one bit.
2. Documents with the same set are one node (the smallest doc_id speaks for them), so groups
   of exact copies never meet in a join.
3. Nodes that share a band key are tied to the key's smallest node; the connected components
   of these ties are the candidate clusters.  Every linked pair that shares a band lies in one.
4. Inside a cluster, a document's pairs are taken in order of the population count of their
   sketches' XOR.  Pairs beyond a bound that a linked pair practically never reaches are skipped,
   as are pairs already connected; the rest are confirmed on their full shingle sets.  In a cluster
   over ``block_weight`` the ties are confirmed first, which is linear in its members; those
   outside its largest part so far then meet all others in blocks, each pair of blocks its own
   group, so no group and no task holds more than two blocks.  Only a spanning set of confirmed
   links leaves a group.
5. Components of the confirmed links, with the members of each node joined back.

A pair at similarity 0.85 shares no band with probability (1 - 0.85**5)**32 = 7e-9.

Words: A-Z lower-cased, runs of ``[^\\x20\\x09-\\x0D]``.  Fewer words than a shingle: the whole
sequence is the one shingle.  Defined cases: null, empty and wordless texts have an empty set,
link with nothing and stay; rows that share a doc_id count as one document; a row without a
doc_id links with nothing, has no component and stays; ties go to the smaller doc_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm.common import U64, as_long, blocks, components, fresh, lower_az, mix64, trim, utf8, windows, words, written

BANDS, ROWS, SKETCH_BITS = 32, 5, 512


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the rows, by row and ascending; first index of each row."""
    h, _, _, first = words(lower_az()[data], offsets, "solid")
    rows = len(offsets) - 1
    w = windows(h, n)
    row = np.searchsorted(first, np.arange(len(w)), side="right") - 1
    inside = np.arange(len(w)) + n <= first[row + 1]
    x, row = w[inside], row[inside]
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < n))
    if len(short):
        x = np.concatenate([x, np.array([windows(h[first[r]:first[r + 1]], int(first[r + 1] - first[r]))[0] for r in short], U64)])
        row = np.concatenate([row, short])
    order = np.lexsort((x, row))
    x, row = x[order], row[order]
    if len(x):
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (row[1:] != row[:-1])
        x, row = x[new], row[new]
    return x, np.searchsorted(row, np.arange(rows + 1))


def signatures(x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sets that are not empty: digests (rows, 2), band keys (rows, BANDS), odd sketches
    (rows, SKETCH_BITS / 64)."""
    at, rows = first[:-1], len(first) - 1
    digest = np.stack([np.add.reduceat(mix64(x ^ U64(s)), at) for s in (0x51ED270B9F1A3C75, 0xA24BAED4963EE407)], 1)
    rng = np.random.default_rng(20240229)
    mul = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=U64) * U64(2) + U64(1)
    add = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=U64)
    sketch = np.zeros((rows, SKETCH_BITS // 64), U64)
    keys = np.empty((rows, BANDS), U64)
    every = np.arange(rows)
    for b in range(BANDS):
        key = np.full(rows, b + 1, U64)
        for r in range(b * ROWS, (b + 1) * ROWS):
            low = np.minimum.reduceat(x * mul[r] + add[r], at)
            key = mix64(key ^ low)
            bit = mix64(low + add[r]) >> U64(64 - 9)
            sketch[every, bit >> U64(6)] ^= U64(1) << (bit & U64(63))
        keys[:, b] = key
    return digest, keys, sketch


FEATURES = "doc_id long, n_shingles long, d1 long, d2 long, sketch binary, bands array<long>"
assert SKETCH_BITS == 1 << 9


def features(docs: DataFrame, text_col: str = "text", doc_col: str = "doc_id", n: int = 5) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in blocks(offsets):
                x, first = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], n)
                size = np.diff(first)
                full = size > 0
                d = np.zeros((j - i, 2), U64)
                sketch, bands = [None] * (j - i), [None] * (j - i)
                if full.any():
                    dd, keys, sk = signatures(x, np.append(first[:-1][full], len(x)))
                    d[full] = dd
                    for r, k, s in zip(np.flatnonzero(full).tolist(), as_long(keys).tolist(), sk):
                        sketch[r], bands[r] = s.tobytes(), k
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(size.astype(np.int64)), pa.array(as_long(d[:, 0].copy())), pa.array(as_long(d[:, 1].copy())),
                    pa.array(sketch, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "d1", "d2", "sketch", "bands"])
        trim()

    return docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, FEATURES)


def sketch_bound(threshold: float, samples: int = BANDS * ROWS, bits: int = SKETCH_BITS) -> float:
    """The XOR population count that a pair at ``threshold`` stays under: five deviations of the
    differing samples and three of the bits they hit."""
    differ = samples * (1 - threshold) + 5 * (samples * threshold * (1 - threshold)) ** 0.5
    mean = bits / 2 * (1 - (1 - 2 / bits) ** (2 * differ))
    return mean + 3 * mean ** 0.5


def confirm(ids: list[int], side: np.ndarray, sets: list[np.ndarray], sketches: np.ndarray, percent: int, bound: float) -> list[tuple[int, int]]:
    """Links that span the components among the given documents; of two blocks (``side``), only
    pairs across are looked at.  Each document meets those that it is not connected with yet,
    the most similar sketches first; memory is that of one document's row of counts."""
    size = np.array([len(s) for s in sets], np.int64)
    label = np.arange(len(ids))  # component so far
    two = bool(side.any()) and not bool(side.all())
    right = np.flatnonzero(side)
    links = []
    for i in range(len(ids)):
        if two and side[i]:
            continue
        others = right if two else np.arange(i + 1, len(ids))
        others = others[(label[others] != label[i]) & (100 * size[others] >= percent * size[i]) & (100 * size[i] >= percent * size[others])]
        count = np.bitwise_count(sketches[others] ^ sketches[i]).sum(1)
        near = count <= bound
        for j in others[near][np.argsort(count[near], kind="stable")].tolist():
            if label[i] == label[j]:
                continue
            if ids[i] == ids[j] or jaccard_reaches(sets[i], sets[j], percent):
                label[label == label[j]] = label[i]
                links.append((ids[i], ids[j]))
    return links


def jaccard_reaches(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def with_texts(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` (with a column rep) and the text of the document rep.  The plan is held to one
    form: the members grow with the corpus, so they are not broadcast at any size."""
    texts = docs.hint("merge").join(rows.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").withColumnRenamed("doc_id", "rep")
    return rows.join(texts, "rep")


def star_links(ties: DataFrame, docs: DataFrame, percent: int, n: int, rows_each: int) -> DataFrame:
    """The ties (a, rep) that are links.  A node's ties are dealt in runs of about ``rows_each``,
    each led by the node itself, so a hub is as many tasks as it needs and a task holds one set."""
    runs = ties.groupBy("a").agg(F.ceil(F.count("*") / rows_each).alias("runs"))
    member = ties.join(runs, "a").select("a", F.pmod(F.xxhash64("rep"), F.col("runs")).alias("run"), F.lit(1).alias("place"), "rep")
    leader = runs.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("runs") - 1)).alias("run"), F.lit(0).alias("place"), F.col("a").alias("rep"))
    rows = with_texts(member.unionByName(leader), docs).select("a", "run", "place", "rep", "text")
    rows = rows.repartition("a", "run").sortWithinPartitions("a", "run", "place")

    def run(batches):
        key, lead = None, None
        for batch in batches:
            a, r, place, rep = (batch.column(c).to_pylist() for c in range(4))
            data, offsets = utf8(batch.column(4))
            out = []
            for i, j in blocks(offsets):
                x, first = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], n)
                for k in range(i, j):
                    own = x[first[k - i]:first[k - i + 1]]
                    if place[k] == 0 and (a[k], r[k]) != key:
                        key, lead = (a[k], r[k]), own.copy()
                    elif jaccard_reaches(lead, own, percent):
                        out.append((a[k], rep[k]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def links(nodes: DataFrame, docs: DataFrame, percent: int, n: int, block_weight: int) -> DataFrame:
    """Confirmed links (a, b) that span the components of the nodes (rep, n_shingles, sketch, bands)."""
    keys = nodes.select("rep", F.explode("bands").alias("key"))
    low = keys.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z").select("key", "a")
    ties = written(keys.join(low, "key").where("a < rep").select("a", "rep").distinct(), "near-ties")
    clusters = components(ties.withColumnRenamed("rep", "b"), "near-candidates").withColumnRenamed("id", "rep")
    weight = (F.col("n_shingles") + 500).alias("weight")
    dealt = written(nodes.join(clusters, "rep").select("rep", "component", weight, "sketch"), "near-members")
    parts = dealt.groupBy("component").agg(F.ceil(F.sum("weight") / block_weight).alias("parts"))
    small = dealt.join(parts.where("parts = 1"), "component").select("rep", "sketch", "component", *(F.lit(0).cast("long").alias(c) for c in ("p", "q", "mine")))

    # Large clusters: their ties first, which is linear.  Who is in the largest part then, meets
    # only those who are not; mostly there is nobody left.
    large = written(dealt.join(parts.where("parts > 1"), "component").select("rep", "component", "weight", "sketch"), "near-large")
    stars = written(star_links(ties.join(large.select("rep"), "rep"), docs, percent, n, 1000), "near-stars")
    label = components(stars, "near-parts").select(F.col("id").alias("rep"), F.col("component").alias("label"))
    state = large.join(label, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    size = state.groupBy("component", "label").agg(F.count("*").alias("rows"))
    core = size.groupBy("component").agg(F.max_by("label", F.struct("rows", "label")).alias("core"))
    state = state.join(core, "component").withColumn("open", F.col("label") != F.col("core"))
    counts = state.groupBy("component").agg(*[F.ceil(F.sum(F.when(F.col("open") == v, F.col("weight")).otherwise(0)) / block_weight).alias(c) for c, v in (("open_parts", True), ("core_parts", False))])
    state = state.join(counts.where("open_parts > 0"), "component")
    state = state.withColumn("mine", F.when(F.col("open"), F.pmod(F.xxhash64("rep"), F.col("open_parts"))).otherwise(
        F.col("open_parts") + F.pmod(F.xxhash64("rep"), F.greatest("core_parts", F.lit(1)))))
    last = F.when(F.col("open"), F.col("open_parts") + F.col("core_parts")).otherwise(F.col("open_parts")) - 1
    pairs = state.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "rep", "sketch", "component", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "mine")

    rows = with_texts(small.unionByName(pairs), docs).select("component", "p", "q", "mine", "rep", "sketch", "text")
    # A block against itself holds each member once, two blocks hold both.
    rows = rows.repartition("component", "p", "q").sortWithinPartitions("component", "p", "q")
    bound = sketch_bound(percent / 100)

    def run(batches):
        def done():
            side = np.array([m != key[1] for m in mine_], bool)
            out = confirm(ids, side, sets, np.stack(sk), percent, bound) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

        key, ids, mine_, sets, sk = None, [], [], [], []
        for batch in batches:
            keys_ = list(zip(*(batch.column(c).to_pylist() for c in range(3))))
            mine_b, rep_b, sk_b = (batch.column(c).to_pylist() for c in (3, 4, 5))
            data, offsets = utf8(batch.column(6))
            for i, j in blocks(offsets):
                x, first = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], n)
                for r in range(i, j):
                    if keys_[r] != key:
                        if ids:
                            yield done()
                        key, ids, mine_, sets, sk = keys_[r], [], [], [], []
                    ids.append(rep_b[r])
                    mine_.append(mine_b[r])
                    sets.append(x[first[r - i]:first[r - i + 1]].copy())
                    sk.append(np.frombuffer(sk_b[r], U64))
        if ids:
            yield done()

    return rows.mapInArrow(run, "a long, b long").unionByName(stars)


def near_duplicates(docs: DataFrame, percent: int = 85, n: int = 5, text_col: str = "text", doc_col: str = "doc_id",
                    block_weight: int = 1_500_000) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.  Linked are documents with
    100 * |intersection| >= ``percent`` * |union| (80 at least)."""
    plain = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    feats = written(features(plain, n=n), "near-features")
    nodes = written(feats.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")), "near-nodes")
    linked = links(nodes, plain, percent, n, block_weight)
    # rows that share a doc_id are one document
    shared = feats.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "d1", "d2").join(nodes.select("d1", "d2", "rep"), ["d1", "d2"])
    shared = shared.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z")
    found = components(linked.unionByName(shared.select("a", F.col("z").alias("b"))), "near-links")
    classes = nodes.select("d1", "d2", "rep").join(found, nodes["rep"] == found["id"], "left").select(
        "d1", "d2", F.coalesce("component", "rep").alias("component"))
    own = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = feats.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["d1", "d2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, text_col: str = "text", doc_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with the same columns: of each near-duplicate group the document with the
    smallest doc_id."""
    name = fresh(docs, "_dropped")
    dropped = near_duplicates(docs, text_col=text_col, doc_col=doc_col, **options).where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.hint("merge").join(dropped, F.col(doc_col) == F.col(name), "left_anti")
