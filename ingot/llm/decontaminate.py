"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

The windows of the benchmark (``n`` consecutive words; a shorter item is one window) are
hashed into one table that every scan task holds.  A document's windows are hashed with
numpy and looked up; each hash hit is compared word for word before it counts.  A benchmark
larger than ``block_bytes`` is taken in blocks of that size, each broadcast in its own pass
over all documents, so the broadcast stays bounded whatever the benchmark's size.

Words: A-Z lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.

Defined cases: a null or wordless text has no words and is never hit; a null or wordless
item has no window; a null item id is written as the empty string; repeated item rows count
once per id, repeated documents each get their own row; an empty benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm.common import blocks, fresh, lower_az, of_state, trim, utf8, windows, words, written

SCAN_TYPE = "struct<n_words:bigint,n_hit:bigint,items:array<string>,mask:binary>"
ARROW_TYPE = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("mask", pa.binary())])


class NgramSet:
    """The windows of some items, in flat arrays: the items' words joined by spaces, and for each
    window length its different windows sorted by hash, each with its place in that text and
    the items that contain it; a bit filter in front."""

    def __init__(self, items: list[tuple[str, str | None]], n: int):
        data, offsets = utf8(pa.array([t or "" for _, t in items], pa.large_string()))
        data = lower_az()[data]
        h, starts, ends, first = words(data, offsets, "alnum")
        self.ids = [i for i, _ in items]
        inside = np.zeros(len(data) + 1, np.int32)
        inside[starts] += 1
        inside[ends] -= 1
        kept = np.cumsum(inside[:-1]) > 0
        size = ends - starts
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size
        text = np.full(int(self.end[-1]) + 1 if len(size) else 0, 32, np.uint8)
        spot = np.ones(len(text), bool)
        spot[self.end] = False
        text[spot] = data[kept]
        self.text = text.tobytes()
        self.tables = {}
        row = np.repeat(np.arange(len(items)), np.diff(first))
        length = np.minimum(n, np.diff(first))
        for k in sorted(set(length[length > 0].tolist())):
            at = np.arange(len(h) - k + 1)
            at = at[(length[row[at]] == k) & (row[at] == row[at + k - 1])]
            w = windows(h, k)[at]
            order = np.lexsort((row[at], w))
            self.tables[k] = self.table(w[order], at[order], row[at][order], k)

    def table(self, w: np.ndarray, at: np.ndarray, row: np.ndarray, k: int) -> tuple:
        """Different windows with their items; equal hashes are told apart by their words."""
        new = np.concatenate([[True], w[1:] != w[:-1]])
        heads = np.flatnonzero(new)
        for i in np.flatnonzero(~new).tolist():
            if self.gram(int(at[i]), k) != self.gram(int(at[i - 1]), k):
                new[i] = True  # two windows under one hash: each occurrence stands for itself
        heads = np.flatnonzero(new)
        bits = min(26, max(16, len(heads).bit_length() + 6))
        f = np.zeros(1 << bits, bool)
        f[w >> np.uint64(64 - bits)] = True
        return w[heads], at[heads], np.append(heads, len(w)), row, bits, f

    def gram(self, at: int, k: int) -> bytes:
        return self.text[self.start[at]:self.end[at + k - 1]]

    def items(self, k: int, h: np.uint64, gram: bytes) -> set[str]:
        """The items that contain the window."""
        hashes, at, span, row, _, _ = self.tables[k]
        i, found = int(np.searchsorted(hashes, h)), set()
        while i < len(hashes) and hashes[i] == h:
            if self.gram(int(at[i]), k) == gram:
                found |= {self.ids[r] for r in row[span[i]:span[i + 1]].tolist()}
            i += 1
        return found

    def scan(self, data: np.ndarray, offsets: np.ndarray):
        """For some rows: words, hit words, items, and the hit words as a mask over all words
        with the rows' first words."""
        data = lower_az()[data]
        h, starts, ends, first = words(data, offsets, "alnum")
        cover = np.zeros(len(h) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(len(offsets) - 1)]
        for k, (known, _, _, _, bits, f) in self.tables.items():
            w = windows(h, k)
            at = np.flatnonzero(f[w >> np.uint64(64 - bits)])
            at = at[known[np.minimum(np.searchsorted(known, w[at]), len(known) - 1)] == w[at]]
            row = np.searchsorted(first, at, side="right") - 1
            inside = at + k <= first[row + 1]
            for i, r in zip(at[inside].tolist(), row[inside].tolist()):
                found = self.items(k, w[i], b" ".join(data[starts[j]:ends[j]].tobytes() for j in range(i, i + k)))
                if found:
                    cover[i] += 1
                    cover[i + k] -= 1
                    items[r] |= found
        hit = np.cumsum(cover[:-1]) > 0
        sums = np.concatenate([[0], np.cumsum(hit)])
        return np.diff(first), sums[first[1:]] - sums[first[:-1]], items, hit, first, starts, ends


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark's (id, text) rows in blocks of about ``block_bytes`` of text."""
    b = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).alias("t")).where("t is not null")
    size = b.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    k = -(-size // block_bytes)
    return [b] if k <= 1 else [b.where(F.pmod(F.xxhash64("i", "t"), F.lit(k)) == j) for j in range(k)]


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", n: int = 10, id_col: str = "item_id",
         bench_text_col: str = "text", block_bytes: int = 8 << 20, into: str = "scan") -> DataFrame:
    """``docs`` with one more column ``into``: a struct of n_words, n_hit, items (ids with an
    occurring window, sorted) and mask (one byte per word, 1 where hit)."""
    at = docs.columns.index(text_col)
    out_schema = docs.select("*", F.lit(None).cast(SCAN_TYPE).alias(into)).schema
    for k, block in enumerate(benchmark_blocks(benchmark, id_col, bench_text_col, block_bytes)):
        grams = docs.sparkSession.sparkContext.broadcast(vars(NgramSet([(r.i, r.t) for r in block.collect()], n)))

        def run(batches, grams=grams, again=k > 0):
            known = of_state(NgramSet, grams.value)
            for batch in batches:
                data, offsets = utf8(batch.column(at))
                rows = []
                for i, j in blocks(offsets):
                    n_words, _, items, hit, first, _, _ = known.scan(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                    for r in range(j - i):
                        mask = hit[first[r]:first[r + 1]]
                        rows.append((int(n_words[r]), mask, items[r]))
                if again:  # earlier blocks' hits stay
                    rows = [(m, mask | (np.frombuffer(o["mask"], np.uint8) > 0), items | set(o["items"]))
                            for (m, mask, items), o in zip(rows, batch.column(batch.num_columns - 1).to_pylist())]
                col = pa.array([(m, int(mask.sum()), sorted(items), mask.tobytes()) for m, mask, items in rows], ARROW_TYPE) if rows else pa.array([], ARROW_TYPE)
                keep = batch.columns[:-1] if again else batch.columns
                yield pa.RecordBatch.from_arrays([*keep, col], names=out_schema.names)
            trim()

        docs = docs.mapInArrow(run, out_schema)
        if k:
            docs = written(docs, "decontaminate")
    return docs


def cut_spans(text: str | None, mask: bytes) -> str | None:
    """``text`` without its hit words; the gap of each removed run becomes one space."""
    if text is None or not any(mask):
        return text
    data = np.frombuffer(text.encode(), np.uint8)
    _, starts, ends, _ = words(lower_az()[data], np.array([0, len(data)]), "alnum")
    out, at, m = [], 0, np.frombuffer(mask, np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], m > 0, [0]])))
    for a, b in zip(edges[::2], edges[1::2]):
        out.append(data[at:starts[a]].tobytes())
        at = ends[b - 1]
    out.append(data[at:].tobytes())
    return b" ".join(x.strip() for x in out).strip().decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the same columns: without contaminated documents (``mode='documents'``) or
    with the hit spans cut from their texts (``mode='spans'``)."""
    name = fresh(docs, "_scan")
    found = scan(docs, benchmark, text_col, into=name, **options)
    if mode == "documents":
        return found.where(F.col(name)["n_hit"] == 0).drop(name)
    if mode != "spans":
        raise ValueError(f"mode {mode!r}: documents or spans")

    def cut(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [cut_spans(t, s["mask"]) for t, s in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())]
            cols = batch.columns[:-1]
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[:-1])

    return found.mapInArrow(cut, docs.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, doc_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256 (the ids, sorted as
    strings and comma-joined), contaminated."""
    s = scan(docs.select(doc_col, options.get("text_col", "text")), benchmark, into="_scan", **options)
    x = F.col("_scan")
    return s.select(F.col(doc_col).alias("doc_id"), x["n_words"].alias("n_words"), x["n_hit"].alias("n_hit"),
                    F.size(x["items"]).cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", x["items"]), 256).alias("items_sha256"), (x["n_hit"] > 0).alias("contaminated"))
