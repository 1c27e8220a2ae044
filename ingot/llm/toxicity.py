"""Toxicity from class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney bigram models are counted, on toxic and on ordinary labelled
documents.  A word's probability backs off from its bigram to the class's continuation counts,
from there to the class's counts of the word's first letters, and last to counts that both
classes share, so that a rare expression gets evidence from its relatives and an unknown one
gets none.  A rarely seen context leans on its backoff by a fixed prior count.  A document is scored
by its length-normalised log-likelihood ratio, over the whole text, over its most toxic window
and over the words that speak clearly for either side; a logistic curve fitted on labelled
documents that the models have not seen turns these into a score between 0 and 1.

Labels are used only from rows with crc32(doc_id as text) mod ``folds`` != ``held``.  Of these, a
quarter by hash of doc_id is left for the curve, which is fitted on at most ``max_rows``
documents of each class (those with the smallest hash); all others are counted, with every word
and pair.  Scores cover every document and whole texts.  Words: A-Z lower-cased, runs of
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.

The counts stay in Spark tables, dealt by key to slots.  Each task packs the documents it reads into
chunks of bounded size, whatever their keys; a chunk asks each slot for its distinct words, stems and
pairs, and the answers meet the chunk again.  Requests and answers are packed, one row for each chunk
and slot; a slot with many requests is copied, and each copy answers a part of the chunks.  Large
inputs take ``ROUNDS`` rounds, so that a part of the requests is on disk at a time.

Defined cases: null, empty and wordless texts have a ratio of 0; without labels of both
classes every score is the labelled share of toxic rows (0 without labels); labels that are
null or repeated: null rows are left out, of repeated ones the largest counts; a document
without a doc_id is not held out.
"""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm.common import U64, as_long, blocks, fresh, lower_az, mix64, trim, utf8, words, written
from ingot.session import fs_delete

DISCOUNT, WINDOW, PRIOR, CLEAR = 0.75, 16, 50.0, 2.0
COUNTED, CHUNK, PART, SLOT = 1 << 20, 4 << 20, 1 << 16, 500_000  # bytes, bytes, words, keys
ROW, SHARE = 64, 16 << 20  # bytes that a row counts for besides its text; bytes of text whose requests one copy of a slot takes
ROUNDS, LARGE = 4, 64 << 20  # rounds of inputs over so many bytes
PAIR, WORD, STEM = 0, 1, 2  # kinds of keys
COUNTS = ("t0", "t1", "a0", "a1", "b0", "b1")  # of a word
WIDTH = {PAIR: 2, WORD: 6, STEM: 2}  # counts of a key


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, hashes of the words' first four bytes, first word of each row."""
    low = lower_az()[data]
    h, starts, ends, first = words(low, offsets, "alnum")
    wide = np.concatenate([low, np.zeros(4, np.uint8)])
    stem = np.zeros(len(h), U64)
    for k in range(4):
        stem |= np.where(starts + k < ends, wide[starts + k], 0).astype(U64) << U64(8 * k)
    return h, mix64(stem + U64(1)), first


def previous(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The word before each word; 0 at the start of a row."""
    v = np.concatenate([np.zeros(1, U64), h])[:-1].copy() if len(h) else h
    v[first[:-1][np.diff(first) > 0]] = 0
    return v


def counted(sample: DataFrame, rounds: int = 1, turn: int = 0) -> DataFrame:
    """Bigram counts of the sample (text, toxic): v, w, n1 (toxic), n0.  Rows without a count tell
    the stem (v) of each word (w).  Of ``rounds`` parts of the rows, dealt by hash, that of this turn."""
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            toxic = np.asarray(batch.column(1).to_pylist(), np.int64)
            for i, j in blocks(offsets, COUNTED):
                h, stem, first = tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                if not len(h):
                    continue
                v, y = previous(h, first), np.repeat(toxic[i:j], np.diff(first))
                own = np.flatnonzero(turns(pair(v, h), rounds) == turn)
                own = own[np.lexsort((h[own], v[own]))]
                a, b, y = v[own], h[own], y[own]
                at = np.flatnonzero(np.concatenate([[len(a) > 0], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[:len(a)])
                n1 = np.add.reduceat(y, at) if len(at) else y
                n = np.diff(np.append(at, len(a)))
                w, one = np.unique(h, return_index=True)
                mine = turns(pair(stem[one], w), rounds) == turn
                w, one = w[mine], one[mine]
                none = np.zeros(len(w), np.int64)
                for columns in ((as_long(a[at]), as_long(b[at]), n1, n - n1), (as_long(stem[one]), as_long(w), none, none)):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["v", "w", "n1", "n0"])
        trim()

    return sample.select("text", "toxic").mapInArrow(run, "v long, w long, n1 long, n0 long").groupBy("v", "w").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(v * U64(0x9E3779B97F4A7C15) + w)


def turns(keys: np.ndarray, rounds: int) -> np.ndarray:
    """The turn of each key, out of ``rounds``; they ascend with the keys, as slots do."""
    return ((keys >> U64(32)) * U64(rounds) >> U64(32)).astype(np.int64)


def slots(keys: np.ndarray, kind: int, n: int) -> np.ndarray:
    """The slot of each key; of one kind they ascend with the keys."""
    return kind * n + ((keys >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


def packed(x: np.ndarray) -> bytes:
    """64-bit values, compressed by byte planes."""
    return pa.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def unpacked(b: bytes, n: int, dtype: type = np.int64) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype)
    return np.ascontiguousarray(np.frombuffer(pa.decompress(b, 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n).T).view(dtype).reshape(n)


def steps(keys: np.ndarray) -> bytes:
    """Sorted keys, packed by their differences."""
    return packed(np.diff(keys, prepend=U64(0)))


def keys_of(b: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpacked(b, n, U64), dtype=U64)


def slot_table(rows: DataFrame, kind: int, n: int) -> DataFrame:
    """One row for each slot of the table (key, counts): slot, n, its sorted keys and counts, packed."""
    names = rows.columns[1:]

    def deal(batches):
        for batch in batches:
            key = batch.column(0).to_numpy().view(U64)
            yield pa.RecordBatch.from_arrays([pa.array(slots(key, kind, n)), *batch.columns], names=["slot", "key", *names])

    def pack(table):
        key = table.column("key").to_numpy().view(U64)
        order = np.argsort(key)
        counts = np.concatenate([table.column(c).to_numpy()[order] for c in names])
        return pa.table({"slot": table.column("slot").slice(0, 1), "n": [len(key)], "keys": pa.array([steps(key[order])], pa.binary()), "counts": pa.array([packed(counts)], pa.binary())})

    return rows.mapInArrow(deal, "slot long, key long, " + ", ".join(f"{c} long" for c in names)).groupBy("slot").applyInArrow(pack, "slot long, n long, keys binary, counts binary")


@contextlib.contextmanager
def short_shuffles(spark):
    """Jobs inside delete their shuffle files when they end: what is needed later is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def delete(*over: DataFrame) -> None:
    """Deletes the written tables ``over``."""
    for x in over:
        for path in {f.rpartition("/")[0] for f in x.inputFiles()}:
            fs_delete(x.sparkSession, path)


def keyed(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(as_long(pair(*(batch.column(k).to_numpy().view(U64) for k in (0, 1))))), batch.column(2), batch.column(3)], names=["key", "n0", "n1"])


class KneserNey:
    """Class-conditional counts in slots; in arrays and names 1 is toxic, 0 ordinary."""

    def __init__(self, bigrams: DataFrame | Iterable[DataFrame], rounds: int = 1):
        """``bigrams``: the written result of ``counted``, or those of its ``rounds`` turns one after the
        other; a turn's is packed into slots, then deleted."""
        parts = [bigrams] if isinstance(bigrams, DataFrame) else bigrams
        self.n, pairs, sides, stems = 0, [], [], []
        for part in parts:
            spark, real = part.sparkSession, part.where("n1 + n0 > 0")
            # a multiple of the rounds, so that a slot's keys are of one turn
            self.n = self.n or rounds * max(-(-int(spark.conf.get("spark.sql.shuffle.partitions")) // rounds), -(-real.count() // SLOT))
            sides.append(written(self.by_word(real), "toxicity-words"))
            stems.append(written(part.where("n1 + n0 = 0").select(F.col("v").alias("stem"), F.col("w").alias("key")), "toxicity-stems"))
            pairs.append(written(slot_table(real.select("v", "w", "n0", "n1").mapInArrow(keyed, "key long, n0 long, n1 long"), PAIR, self.n), "toxicity-slots"))
            delete(*([part] if rounds > 1 else []))
        union = lambda tables: functools.reduce(DataFrame.unionByName, tables)
        word = written(union(sides).groupBy("key").agg(*[F.sum(c).alias(c) for c in COUNTS]), "toxicity-words")
        delete(*sides)
        stem = written(word.where("t0 + t1 > 0").join(union(stems), "key").groupBy(F.col("stem").alias("key")).agg(F.sum("t0").alias("s0"), F.sum("t1").alias("s1")), "toxicity-stems")
        delete(*stems)
        w = word.where("t0 + t1 > 0").agg(F.count("*"), *[F.coalesce(F.sum(x), F.lit(0)) for x in ("t0", "t1")], *[F.count_if(F.col(x) > 0) for x in ("t0", "t1")]).first()
        s = stem.agg(F.count("*"), F.count_if(F.col("s0") > 0), F.count_if(F.col("s1") > 0)).first()
        self.words, self.stems = w[0], s[0]
        self.bigram_types, self.word_types, self.stem_types = np.array(w[1:3], float), np.array(w[3:5], float), np.array(s[1:3], float)
        if self.bigram_types.all():
            rest = written(slot_table(word, WORD, self.n).unionByName(slot_table(stem, STEM, self.n)), "toxicity-slots")
            delete(word, stem)
            self.table = union([*pairs, rest])

    @staticmethod
    def by_word(real: DataFrame) -> DataFrame:
        """Sums (``COUNTS``) of each word: its different predecessors by class (t), occurrences (a) and different
        words (b) after it."""
        zero = F.lit(0).cast("long")
        one = lambda c: (F.col(c) > 0).cast("long")
        sides = real.select(F.col("v").alias("key"), F.col("n1").alias("a1"), F.col("n0").alias("a0"), one("n1").alias("b1"), one("n0").alias("b0"), zero.alias("t1"), zero.alias("t0")).unionByName(
            real.select(F.col("w").alias("key"), *[zero.alias(c) for c in ("a1", "a0", "b1", "b0")], one("n1").alias("t1"), one("n0").alias("t0")))
        return sides.groupBy("key").agg(*[F.sum(c).alias(c) for c in COUNTS])

    def sums(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "table"}


def ratios(sums: dict, pairs: np.ndarray, word: np.ndarray, context: np.ndarray, stem: np.ndarray) -> np.ndarray:
    """log P(word | context, toxic) - log P(word | context, ordinary) of each word, from the counts of
    its pair (2, n), itself and its context (6, n), and its stem (2, n)."""
    total = sums["bigram_types"].sum() + 0.5 * (sums["stems"] + 1)
    shared = (stem.sum(0) + 0.5) / total
    known = word[0] + word[1] > 0
    within = np.where(known, np.minimum((word[0] + word[1] + 0.5) / (stem.sum(0) + 1.0), 1), 0.5 / (1 + sums["words"]))
    out = []
    for c in (0, 1):
        types, t, a, b = sums["bigram_types"][c], word[c], context[2 + c], context[4 + c]
        stem_p = np.maximum(stem[c] - DISCOUNT, 0) / types + DISCOUNT * sums["stem_types"][c] / types * shared
        p = np.maximum(t - DISCOUNT, 0) / types + DISCOUNT * sums["word_types"][c] / types * stem_p * within
        out.append((p * (DISCOUNT * b + PRIOR) + np.maximum(pairs[c] - DISCOUNT, 0)) / (a + PRIOR))
    return np.log(out[1] / out[0])


EVIDENCE = ["whole", "window", "clear", "share"]


def evidence(ratio: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(rows, 4): the ratio per word of each row; that of its highest window of ``WINDOW`` words
    (of the whole row if shorter); what clear words add per word; the share of clear words."""
    out = np.zeros((len(first) - 1, len(EVIDENCE)))
    if len(ratio):
        n = np.diff(first)
        full = n > 0
        for k, x in ((0, np.clip(ratio, -CLEAR, 3 * CLEAR)), (2, np.maximum(ratio - CLEAR, 0)), (3, (ratio > CLEAR).astype(float))):
            total = np.concatenate([[0.0], np.cumsum(x)])
            out[full, k] = (total[first[1:]] - total[first[:-1]])[full] / n[full]
        out[full, 1] = out[full, 0]
        if len(ratio) >= WINDOW:
            total = np.concatenate([[0.0], np.cumsum(ratio)])
            w = (total[WINDOW:] - total[:-WINDOW]) / WINDOW
            row = np.searchsorted(first, np.arange(len(w)), side="right") - 1
            inside = np.flatnonzero(np.arange(len(w)) + WINDOW <= first[row + 1])
            if len(inside):
                r = row[inside]
                at = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
                out[r[at], 1] = np.maximum.reduceat(w[inside], at)
    return out


def rounds_of(size: int) -> int:
    return ROUNDS if size > LARGE else 1


def asked(text: pa.ChunkedArray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Of a chunk's texts: the sorted distinct keys by kind; the places among them of each word's
    pair, of itself, its stem and its context; first word of each row."""
    data, offsets = utf8(text)
    parts = [tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in blocks(offsets)]
    h, stem = (np.concatenate([x[k] for x in parts] or [np.zeros(0, U64)]) for k in (0, 1))
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[2]) for x in parts] or [np.zeros(0, np.int64)]))])
    v = previous(h, first)
    pairs, p_at = np.unique(pair(v, h), return_inverse=True)
    word, w_at = np.unique(np.append(h, U64(0)), return_inverse=True)
    stems, s_at = np.unique(stem, return_inverse=True)
    w_at = w_at[:-1]
    v_at = np.append(0, w_at)[:-1] if len(w_at) else w_at
    v_at[v == 0] = 0  # the key 0 is the first
    return [pairs, word, stems], [p_at, w_at, s_at, v_at], first


def chunked(docs: DataFrame, columns: list[str], text_col: str) -> DataFrame:
    """The rows of ``docs`` in chunks of about ``CHUNK`` bytes, as the tasks read them: chunk, rows (the
    ``columns``, packed).  A chunk's number holds for this run of the tasks only, so the result is written."""
    def run(batches):
        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            _, offsets = utf8(batch.column(columns.index(text_col)))
            offsets = offsets + ROW * np.arange(len(offsets))
            for i, j in blocks(offsets, CHUNK):
                more = int(offsets[j] - offsets[i])
                if held and size + more > CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([stored(held)], pa.binary())], names=["chunk", "rows"])
                    held, size, number = [], 0, number + 1
                held.append(batch.slice(i, j - i))
                size += more
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([stored(held)], pa.binary())], names=["chunk", "rows"])
        trim()

    return docs.select(*columns).mapInArrow(run, "chunk long, rows binary")


def stored(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(pa.Table.from_batches(batches).combine_chunks())
    return sink.getvalue().to_pybytes()


def restored(rows: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(rows.as_buffer()).read_all()


def gathered(docs: DataFrame, model: KneserNey, text_col: str, keep: list[str], size: int) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the evidence (``evidence_names``), written."""
    n, sums = model.n, model.sums()
    schema = docs.select(*keep).withColumns({k: F.lit(0.0) for k in evidence_names(docs)}).schema
    rounds = rounds_of(size)
    copies = max(1, -(-size // (rounds * n * SHARE)))
    code = F.xxhash64(*docs.columns)

    def ask(batches):
        for batch in batches:
            for chunk, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                out = []
                for kind, keys in enumerate(asked(restored(rows).column(text_col))[0]):
                    at = slots(keys, kind, n)
                    edges = np.append(np.flatnonzero(np.diff(at, prepend=-1)), len(at))
                    out += [(int(at[i]), chunk % copies, chunk, int(j - i), steps(keys[i:j])) for i, j in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["slot", "copy", "chunk", "n", "keys"])
        trim()

    def answer(batches):
        """A copy of a slot's table comes before its requests, which pass one by one."""
        slot, width, own, counts = None, 0, np.zeros(0, U64), np.zeros((0, 1), np.int64)
        for batch in batches:
            out = []
            for at, copy, to, m, keys, values in zip(*(batch.column(k).to_pylist() for k in range(4)), batch.column(4), batch.column(5)):
                if (at, copy) != slot:
                    slot, width, own = (at, copy), WIDTH[at // n], np.zeros(0, U64)
                    counts = np.zeros((width, 1), np.int64)
                if to is None:
                    own, counts = keys_of(keys.as_py(), m), np.concatenate([unpacked(values.as_py(), m * width).reshape(width, m), np.zeros((width, 1), np.int64)], 1)
                    continue
                of = keys_of(keys.as_py(), m)
                place = np.searchsorted(own, of)
                place[np.append(own, U64(0))[place] != of] = len(own)
                out.append((to, at, m, packed(counts[:, place].ravel())))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["chunk", "slot", "got", "counts"])
        trim()

    def score(key, left, right):
        rows = restored(left.column("rows")[0])
        keys, (p_at, w_at, s_at, v_at), first = asked(rows.column(text_col))
        found = []
        got = sorted(zip(right.column("slot").to_pylist(), right.column("got").to_pylist(), right.column("counts")), key=lambda r: r[0])
        for kind in (PAIR, WORD, STEM):
            x = [unpacked(b.as_py(), m * WIDTH[kind]).reshape(WIDTH[kind], m) for slot, m, b in got if slot // n == kind]
            found.append(np.concatenate([np.zeros((WIDTH[kind], 0), np.int64), *x], 1))
            if found[-1].shape[1] != len(keys[kind]):
                raise ValueError("the answers are not those of the chunk's rows")
        ratio = np.zeros(len(w_at))
        for i in range(0, len(ratio), PART):
            k = slice(i, i + PART)
            ratio[k] = ratios(sums, found[PAIR][:, p_at[k]], found[WORD][:, w_at[k]], found[WORD][:, v_at[k]], found[STEM][:, s_at[k]])
        out = rows.select(keep)
        for name, x in zip(schema.names[-len(EVIDENCE):], evidence(ratio, first).T):
            out = out.append_column(name, pa.array(x.copy()))
        del keys, found, ratio, p_at, w_at, s_at, v_at
        trim()
        return out

    parts = []
    tables = model.table.select("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias("copy"), F.lit(None).cast("long").alias("chunk"), "n", "keys", "counts")
    for r in range(rounds):
        own = written(chunked(docs.where(F.pmod(code, F.lit(rounds)) == r), list(dict.fromkeys([*keep, text_col])), text_col), "toxicity-chunks")
        requests = own.mapInArrow(ask, "slot long, copy long, chunk long, n long, keys binary")
        both = requests.withColumn("counts", F.lit(None).cast("binary")).unionByName(tables)
        answers = both.repartition("slot", "copy").sortWithinPartitions("slot", "copy", F.asc_nulls_first("chunk")).mapInArrow(answer, "chunk long, slot long, got long, counts binary")
        parts.append(written(own.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema), "toxicity-evidence"))
        delete(own)
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def evidence_names(docs: DataFrame) -> list[str]:
    return [fresh(docs, f"_{k}") for k in EVIDENCE]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (weight * (p - y)) + 1e-3 * beta
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(beta)), g)
        beta -= np.clip(step, -50, 50)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def remainder(col, folds: int = 4):
    return F.crc32(col.cast("string").cast("binary")) % folds


def scored(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, folds: int = 4, held: int = 2, text_col: str = "text", into: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) with one more: the score of the whole text.  The curve is fitted on at most
    ``max_rows`` labelled documents of each class, the counts are of all others."""
    with short_shuffles(docs.sparkSession):
        return _scored(docs, labels, max_rows, folds, held, text_col, into, keep or docs.columns)


def _scored(docs: DataFrame, labels: DataFrame, max_rows: int, folds: int, held: int, text_col: str, into: str, keep: list[str]) -> DataFrame:
    rows = labels.select("doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (remainder(F.col("doc_id"), folds) != held))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    if len(totals) < 2:
        return docs.select(*keep, F.lit(share).alias(into))
    unseen = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0
    learnt = docs.select("doc_id", F.coalesce(F.col(text_col), F.lit("")).alias("text")).where((remainder(F.col("doc_id"), folds) != held) & ~unseen).join(rows, "doc_id")
    learnt = written(learnt.select("text", "toxic"), "toxicity-learnt")
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    rounds = rounds_of(size)
    model = KneserNey((written(counted(learnt, rounds, turn), "toxicity-bigrams") for turn in range(rounds)), rounds)
    delete(learnt)
    if not model.bigram_types.all():
        return docs.select(*keep, F.lit(share).alias(into))
    names, found = evidence_names(docs), gathered(docs, model, text_col, keep, size)
    order = F.xxhash64("doc_id")
    ids = rows.where("toxic = 1").where(unseen).orderBy(order, "doc_id").limit(max_rows).unionByName(rows.where("toxic = 0").where(unseen).orderBy(order, "doc_id").limit(max_rows))
    # at most 2 * max_rows ids
    x = found.select("doc_id", *names).join(F.broadcast(ids), "doc_id").select(*names, "toxic").toPandas()
    y = x["toxic"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        beta = np.array([10.0, 0.0, 0.0, 0.0, np.log(max(share, 1e-6) / max(1 - share, 1e-6))])
    else:
        weight = np.where(y == 1, share * len(y) / y.sum(), (1 - share) * len(y) / (len(y) - y.sum()))
        beta = logistic(x[names].to_numpy(), y, weight)
    z = F.lit(float(beta[-1]))
    for name, b in zip(names, beta):
        z = z + F.col(name) * float(b)
    return found.withColumn(into, 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z))))).select(*keep, into)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = 6000) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    out = scored(docs.select("doc_id", "text"), labels, max_rows, keep=["doc_id"])
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = 6000) -> DataFrame:
    """``docs`` with the same columns, without those scored ``threshold`` or more."""
    name = fresh(docs, "_score")
    return scored(docs, labels, max_rows, into=name).where(F.col(name) < threshold).drop(name)
