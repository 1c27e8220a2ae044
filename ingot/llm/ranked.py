"""Ranked lexical search by branch and bound over FP-trees of documents.

Items (queries) are short texts, documents are all rows.  ``term_vectors`` finds each document's
vector, restricted to terms of the items, in one scan; term counts and sums are taken from the written
vectors.  ``search`` orders a vector's terms by descending document frequency, so that vectors of a
block of documents, sorted, are the paths of an FP-tree.  A subtree is a run of the sorted documents;
each node keeps the largest tf of every term and the smallest m below it, which bound the scores of its
documents from above.  For each item the tree is walked depth first, best child first, and a subtree
whose bound is below the item's tenth score so far is left out.  Scores are integers, so results are
exact.  A task carries an item's best from block to block; its last ten go to a window per item.

Items are broadcast in blocks of at most ``block_bytes`` of text, each in its own pass over the
documents, and searched in groups of at most ``GROUP`` terms, so neither grows with the benchmark.

Terms: runs of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]``, A-Z lower-cased.  A term's weight is
floor(1000 ln((2N + 2) / (2 df + 1))), a document's m is 100 - 90 + (90 n N) div L, and its score for
an item the sum over the item's terms of w * ((10**9 tf) div (1000 tf + 8 m)).

Defined cases: null and termless texts are in no result and not counted in N; null and termless items
have no rows; equal item rows count once, rows of one item_id with different texts are items of their
own; repeated documents are ranked each; equal scores by ascending doc_id, a null doc_id last.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ingot.llm.common import U64, Lanes, blocks, lower_az, of_state, utf8, words, written

GROUP, BLOCK, DOCS, LEAF = 4096, 1 << 22, 1 << 15, 32  # terms of a group, entries and documents of a tree, documents of a leaf
VECTOR = "n long, terms array<int>, counts array<int>"


class Terms:
    """The different terms of some items: their hashes, sorted, sizes and bytes; for each item its
    terms."""

    def __init__(self, texts: list[str]):
        data, offsets = utf8(pa.array(texts, pa.large_string()))
        data = lower_az()[data]
        h, starts, ends, first = words(data, offsets, "alnum")
        term = {}
        own = np.array([term.setdefault(data[a:b].tobytes(), len(term)) for a, b in zip(starts.tolist(), ends.tolist())], np.int64)
        one = np.unique(own, return_index=True)[1]
        order = np.argsort(h[one], kind="stable")
        self.hashes, self.size = h[one][order], (ends - starts)[one][order]
        self.starts, self.text = starts[one][order], data
        place = np.empty(len(one), np.int64)
        place[order] = np.arange(len(one))
        self.items = [np.unique(place[own[i:j]]) for i, j in zip(first[:-1].tolist(), first[1:].tolist())]
        self.bits = min(24, max(12, len(one).bit_length() + 5))
        self.filter = np.zeros(1 << self.bits, bool)
        self.filter[self.hashes >> U64(64 - self.bits)] = True

    def vectors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of some rows: terms with repeats of each; row, term and count of their known terms."""
        data = lower_az()[data]
        h, starts, ends, first = words(data, offsets, "alnum")
        n = np.diff(first)
        w = np.flatnonzero(self.filter[h >> U64(64 - self.bits)]) if len(self.hashes) else np.zeros(0, np.int64)
        near = np.minimum(np.searchsorted(self.hashes, h[w]), max(0, len(self.hashes) - 1))
        hit = self.hashes[near] == h[w]
        w, near = w[hit], near[hit]
        # equal hashes stand side by side; the bytes decide
        found, term = [], []
        at, own = Lanes(data), Lanes(self.text)
        while len(w):
            same = (ends[w] - starts[w]) == self.size[near]
            i, k = np.flatnonzero(same), 0
            while len(i):  # eight bytes at a time
                a, b = starts[w[i]] + k, self.starts[near[i]] + k
                same[i] = at.read(a, ends[w[i]]) == own.read(b, b - k + self.size[near[i]])
                k += 8
                i = i[same[i] & (self.size[near[i]] > k)]
            found.append(w[same])
            term.append(near[same])
            w, near = w[~same], near[~same] + 1
            on = (near < len(self.hashes)) & (self.hashes[np.minimum(near, len(self.hashes) - 1)] == h[w])
            w, near = w[on], near[on]
        w, t = np.concatenate([np.zeros(0, np.int64), *found]), np.concatenate([np.zeros(0, np.int64), *term])
        row = np.searchsorted(first, w, side="right") - 1
        key, count = np.unique(row * max(1, len(self.hashes)) + t, return_counts=True)
        return n, key // max(1, len(self.hashes)), key % max(1, len(self.hashes)), count


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """Different (id, text) rows with a text, in blocks of about ``block_bytes``."""
    b = items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null").distinct()
    size = b.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    k = -(-size // block_bytes)
    return [b] if k <= 1 else [b.where(F.pmod(F.xxhash64("i", "t"), F.lit(k)) == j) for j in range(k)]


def term_vectors(docs: DataFrame, known: dict, doc_col: str, text_col: str) -> DataFrame:
    """doc_id and ``VECTOR`` of each document: terms with repeats; the items' terms in it, their counts."""
    shipped = docs.sparkSession.sparkContext.broadcast(known)  # a block's terms, at most a few times block_bytes
    rows = docs.select(F.col(doc_col).alias("doc_id"), text_col)

    def run(batches):
        terms = of_state(Terms, shipped.value)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in blocks(offsets):
                n, row, term, count = terms.vectors(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                ends = pa.array(np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), *[
                    pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (term, count)]], names=["doc_id", "n", "terms", "counts"])

    kind = docs.schema[doc_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {VECTOR}")


def frequencies(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """Documents holding each term of a block; counted per task, then summed."""
    def run(batches):
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for r in vectors.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # a block's terms
        out[r.term] = r.df
    return out


def value(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Tree:
    """FP-tree of a block of documents (a CSR of term places, ascending with the terms' order, and counts)."""

    def __init__(self, indptr: np.ndarray, terms: np.ndarray, tf: np.ndarray, m: np.ndarray, width: int):
        big = terms.astype(">u2" if width <= 1 << 16 else ">u4").tobytes()
        size = 2 if width <= 1 << 16 else 4
        ptr = (indptr * size).tolist()
        paths = [big[a:b] for a, b in zip(ptr[:-1], ptr[1:])]
        order = sorted(range(len(paths)), key=paths.__getitem__)
        self.order = np.array(order, np.int64)
        length = np.diff(indptr)[self.order]
        self.indptr = np.concatenate([[0], np.cumsum(length)])
        pick = np.repeat(indptr[:-1][self.order] - self.indptr[:-1], length) + np.arange(int(self.indptr[-1]))
        self.terms, self.tf, self.m = terms[pick], tf[pick], m[self.order]
        common = np.zeros(len(order) + 1, np.int64)  # terms that a document shares with the one before it
        for i in range(1, len(order)):
            a, b = self.terms[self.indptr[i - 1]:self.indptr[i]], self.terms[self.indptr[i]:self.indptr[i + 1]]
            k = min(len(a), len(b))
            other = a[:k] != b[:k]
            at = int(other.argmax()) if k else 0
            common[i] = at if k and other[at] else k
        self.common, self.width = common, width
        self.low, self.high, self.children, self.peak, self.m_min = [], [], [], [], []
        self.build(len(order))

    def node(self, a: int, b: int) -> int:
        self.low.append(a)
        self.high.append(b)
        self.children.append(None)
        return len(self.low) - 1

    def build(self, n: int) -> None:
        """A node for the run of documents below each branching; children of few documents stand together
        in leaves."""
        todo = [self.node(0, n)]
        while todo:
            k = todo.pop()
            a, b = self.low[k], self.high[k]
            if b - a <= LEAF:
                continue
            inner = self.common[a + 1:b]
            cut = a + 1 + np.flatnonzero(inner == inner.min())
            if len(cut) == b - a - 1 and (np.diff(self.indptr[a:b + 1]) == inner[0]).all():
                cut = np.arange(a + LEAF, b, LEAF)  # equal paths
            edges, kids, begin = [a, *cut.tolist(), b], [], a
            for x, y in zip(edges[:-1], edges[1:]):
                if y - begin > LEAF:
                    if x > begin:
                        kids.append(self.node(begin, x))
                    begin = x
                    if y - x > LEAF:
                        kids.append(self.node(x, y))
                        todo.append(kids[-1])
                        begin = y
            if begin < b:
                kids.append(self.node(begin, b))
            self.children[k] = np.array(kids)
        self.peak = np.zeros((len(self.low), self.width), np.int32)
        self.m_min = np.zeros(len(self.low), np.int64)
        for k in range(len(self.low) - 1, -1, -1):  # children come after their node
            if self.children[k] is None:
                s = slice(self.indptr[self.low[k]], self.indptr[self.high[k]])
                np.maximum.at(self.peak[k], self.terms[s], self.tf[s])
                self.m_min[k] = self.m[self.low[k]:self.high[k]].min()
            else:
                self.peak[k], self.m_min[k] = self.peak[self.children[k]].max(0), self.m_min[self.children[k]].min()

    def scores(self, k: int, place: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Scores of a leaf's documents; ``place`` has a term's place among the item's terms or -1."""
        a, b = self.low[k], self.high[k]
        s = slice(self.indptr[a], self.indptr[b])
        at = place[self.terms[s]]
        row = np.repeat(np.arange(b - a), np.diff(self.indptr[a:b + 1]))
        hit = at >= 0
        out = np.zeros(b - a, np.int64)
        np.add.at(out, row[hit], value(w[at[hit]], self.tf[s][hit], self.m[a:b][row[hit]]))
        return out

    def walk(self, terms: np.ndarray, w: np.ndarray, place: np.ndarray, best: list, top: int, ids: list) -> int:
        """Adds the documents to ``best``, the ``top`` best so far as a heap of (score, id that orders
        downwards); the number of leaves that were read."""
        stack, read = [(None, 0)], 0
        while stack:
            bound, k = stack.pop()
            if bound is not None and (bound <= 0 or len(best) == top and bound < best[0][0]):
                continue
            if self.children[k] is None:
                read += 1
                score = self.scores(k, place, w)
                floor = best[0][0] if len(best) == top else 1
                for i in np.flatnonzero(score >= max(1, floor)).tolist():
                    doc = ids[int(self.order[self.low[k] + i])]
                    entry = (int(score[i]), Last(doc))
                    if len(best) < top:
                        heapq.heappush(best, entry)
                    elif best[0] < entry:
                        heapq.heapreplace(best, entry)
                continue
            kids = self.children[k]
            bounds = value(w, self.peak[np.ix_(kids, terms)].astype(np.int64), self.m_min[kids][:, None]).sum(1)
            order = np.argsort(bounds, kind="stable")
            stack += zip(bounds[order].tolist(), kids[order].tolist())
        return read


class Last:
    """Orders ids downwards, None below all."""

    __slots__ = ("id",)

    def __init__(self, id_):
        self.id = id_

    def __lt__(self, other):
        return self.id is None and other.id is not None or self.id is not None and other.id is not None and self.id > other.id

    def __eq__(self, other):
        return self.id == other.id


def groups(items: list[np.ndarray], limit: int) -> list[list[int]]:
    """Items in groups of at most ``limit`` different terms (or a single item)."""
    out, seen = [], set()
    for k, t in enumerate(items):
        t = set(t.tolist())
        if not out or len(seen | t) > limit:
            out.append([])
            seen = set()
        out[-1].append(k)
        seen |= t
    return out


def search(vectors: DataFrame, items: list[np.ndarray], df: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """The best ``top`` of each task for each item: item (its place), doc_id, score."""
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    rank = np.empty(len(df), np.int64)
    rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
    parts = []
    for members in groups(items, GROUP):
        terms = np.unique(np.concatenate([items[k] for k in members]))
        terms = terms[np.argsort(rank[terms])]
        at = np.full(len(df), -1, np.int32)
        at[terms] = np.arange(len(terms))
        parts.append((at, weight[terms], [(k, np.sort(at[items[k]])) for k in members]))
    shipped = vectors.sparkSession.sparkContext.broadcast(parts)  # a block's terms for each of its groups
    kind = vectors.schema["doc_id"].dataType

    def run(batches):
        best: dict[int, list] = {}

        def blocked():
            held, size, rows = [], 0, 0
            for batch in batches:
                for i in range(0, batch.num_rows, 4096):
                    held.append(batch.slice(i, 4096))
                    size, rows = size + len(held[-1].column(2).flatten()), rows + held[-1].num_rows
                    if size >= BLOCK or rows >= DOCS:
                        yield pa.Table.from_batches(held)
                        held, size, rows = [], 0, 0
            if held:
                yield pa.Table.from_batches(held)

        for table in blocked():
            table = table.combine_chunks()
            lists, counts = table.column(2).combine_chunks(), table.column(3).combine_chunks()
            if isinstance(lists, pa.ChunkedArray):
                lists, counts = pa.concat_arrays(lists.chunks), pa.concat_arrays(counts.chunks)
            sizes = np.diff(lists.offsets.to_numpy())
            term, tf, n = lists.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64), table.column(1).to_numpy()
            if len(n) and 90 * int(n.max()) * n_docs < 1 << 63:
                m = 10 + 90 * n * n_docs // max(1, n_terms)
            else:
                m = np.array([10 + 90 * int(x) * n_docs // max(1, n_terms) for x in n], np.int64)
            row = np.repeat(np.arange(len(n)), sizes)
            for at, w, members in shipped.value:
                t = at[term]
                own = np.flatnonzero(t >= 0)
                own = own[np.lexsort((t[own], row[own]))]
                used = np.flatnonzero(np.bincount(row[own], minlength=len(n)))
                if not len(used):
                    continue
                ids = table.column(0).take(pa.array(used)).to_pylist()
                indptr = np.append(np.searchsorted(row[own], used), len(own))
                tree = Tree(indptr, t[own], tf[own], m[used], len(w))
                for k, mine in members:
                    place = np.full(len(w), -1, np.int64)
                    place[mine] = np.arange(len(mine))
                    tree.walk(mine, w[mine], place, best.setdefault(k, []), top, ids)
        rows = [(k, doc.id, score) for k, heap in best.items() for score, doc in heap]
        names = ["item", "doc_id", "score"]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), table_type, pa.int64()))], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    table_type = to_arrow_type(kind)
    return vectors.mapInArrow(run, f"item long, doc_id {kind.simpleString()}, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = 10, doc_col: str = "doc_id", text_col: str = "text", id_col: str = "item_id",
           item_text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """The ``top`` best documents of each item, if their score is above 0: item_id, rank, doc_id, score."""
    spark, out = docs.sparkSession, None
    for block in item_blocks(items, id_col, item_text_col, block_bytes):
        rows = block.collect()  # block_bytes of text
        known = Terms([r.t for r in rows])
        if not len(known.hashes):
            continue
        of = vars(known).copy()
        lists = of.pop("items")
        vectors = written(term_vectors(docs, of, doc_col, text_col), "ranked-vectors")
        n_docs, n_terms = vectors.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        found = search(vectors, lists, frequencies(vectors, len(known.hashes)), n_docs, n_terms, top)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(k, r.i) for k, r in enumerate(rows)], f"item long, item_id {items.schema[id_col].dataType.simpleString()}")
        found = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = out.unionByName(found) if out is not None else found
    if out is None:
        kinds = items.schema[id_col].dataType.simpleString(), docs.schema[doc_col].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    return out
