"""Grace hash deduplication: texts are equal when their complete normalised contents are.

Each scan task first folds its own equal texts, so a text that fills a third of the corpus
crosses the shuffle once per task.  The folded records are dealt by a hash of the content; a
task then deduplicates its share the Grace way: records enter an open-addressing table that
compares complete contents; once the table's contents outgrow the memory budget, they and all
further records go to spill files by the next bits of their hash, and each file is treated the
same way, until every bucket fits.  Equal contents always share a bucket and take one entry.
The classes are joined back to the documents by their content's SHA-256; contents that differ
under one SHA-256 would be noticed by the comparison and raise.

Normal form: without the characters ``[\\x20\\x09-\\x0D]``.  Kept is the text with the most code
points in the original, of those the smallest doc_id.  Spill files live in the task's own
temporary folder and are gone when it ends; a lost task starts again from its shuffle input.

Defined cases: null counts as empty, and empty texts are equal to each other; rows that share
a doc_id are rows of their own, and one kept doc_id keeps all its rows of the group; a row
without a doc_id loses ties against any other.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm.common import fresh, utf8

SPACE = b" \t\n\x0b\x0c\r"
BUDGET, FANOUT = 48 << 20, 16
NO_ID = (1 << 63) - 1
HEAD = "<32sqqqI"  # digest, code points, doc_id, rows, bytes of content


def normal(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, SPACE)


class OpenTable:
    """Open addressing with linear probing over complete contents; entries are
    [digest, content, code points, doc_id, rows]."""

    def __init__(self):
        self.slots, self.entries, self.bytes = [-1] * 1024, [], 0

    def place(self, digest: bytes, content: bytes, skip: int) -> int:
        mask = len(self.slots) - 1
        i = (int.from_bytes(digest[:8], "little") >> skip) & mask
        while self.slots[i] >= 0:
            e = self.entries[self.slots[i]]
            if e[0] == digest:
                if e[1] != content:
                    raise ValueError(f"different contents under one digest {digest.hex()}")
                return i
            i = (i + 1) & mask
        return i

    def add(self, record: tuple, skip: int = 0) -> None:
        digest, content, points, doc, rows = record
        i = self.place(digest, content, skip)
        if self.slots[i] >= 0:
            e = self.entries[self.slots[i]]
            e[4] += rows
            if (-points, doc) < (-e[2], e[3]):
                e[2], e[3] = points, doc
            return
        self.slots[i] = len(self.entries)
        self.entries.append([digest, content, points, doc, rows])
        self.bytes += len(content) + 200
        if 2 * len(self.entries) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for k, e in enumerate(self.entries):
                self.slots[self.place(e[0], e[1], skip)] = k


def spilled(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while head := f.read(struct.calcsize(HEAD)):
            digest, points, doc, rows, n = struct.unpack(HEAD, head)
            yield digest, f.read(n), points, doc, rows


def grace(records: Iterable[tuple], budget: int = BUDGET, level: int = 0, folder: str | None = None) -> Iterator[list]:
    """The classes of ``records`` (digest, content, code points, doc_id, rows)."""
    table, files, skip = OpenTable(), None, 4 * level
    own = None
    try:
        for r in records:
            if files is None:
                table.add(r, skip)
                if table.bytes <= budget or len(table.entries) < 2 or level >= 15:
                    continue
                own = tempfile.TemporaryDirectory(prefix="grace-", dir=folder)
                files = [open(os.path.join(own.name, f"{k:02d}"), "wb") for k in range(FANOUT)]
                todo, table = table.entries, OpenTable()
            else:
                todo = (r,)
            for digest, content, points, doc, rows in todo:
                # the last bytes of the digest deal the spill files, the first ones the table
                f = files[(int.from_bytes(digest[-8:], "little") >> skip) % FANOUT]
                f.write(struct.pack(HEAD, digest, points, doc, rows, len(content)))
                f.write(content)
        if files is None:
            yield from table.entries
            return
        for f in files:
            f.close()
        for f in files:
            yield from grace(spilled(f.name), budget, level + 1, own.name)
            os.remove(f.name)
    finally:
        for f in files or ():
            f.close()
        if own is not None:
            own.cleanup()


RECORDS = "digest binary, content binary, points long, doc long, n long"


def as_batches(rows: Iterable, names: list[str], types: list[pa.DataType], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most about ``limit`` bytes, counting the binary columns."""
    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    out, size = [], 0
    for r in rows:
        out.append(r)
        size += 64 + sum(len(x) for x in r if isinstance(x, bytes))
        if size > limit:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def folded(docs: DataFrame, budget: int) -> DataFrame:
    """Records of the documents (doc_id, text), equal texts of a task folded as far as they meet
    within the memory budget."""
    names, types = ["digest", "content", "points", "doc", "n"], [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        table = OpenTable()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                content = normal(text)
                table.add((hashlib.sha256(content).digest(), content, len(text or ""), NO_ID if doc is None else doc, 1))
                if table.bytes > budget:
                    yield from as_batches(table.entries, names, types)
                    table = OpenTable()
        yield from as_batches(table.entries, names, types)

    return docs.mapInArrow(run, RECORDS)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of each row."""
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            raw, at = data.tobytes(), offsets.tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([hashlib.sha256(raw[a:b].translate(None, SPACE)).digest() for a, b in zip(at[:-1], at[1:])], pa.binary())],
                                             names=["doc_id", "digest"])

    return docs.mapInArrow(run, "doc_id long, digest binary")


def classes(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """One row per different content: digest, keep_id, group_size."""
    names, types = ["digest", "keep_id", "group_size"], [pa.binary(), pa.int64(), pa.int64()]

    def run(batches):
        records = (tuple(x.as_py() for x in row) for b in batches for row in zip(*b.columns))
        yield from as_batches(((e[0], None if e[3] == NO_ID else e[3], e[4]) for e in grace(records, budget)), names, types)

    return folded(docs, budget).repartition("digest").mapInArrow(run, "digest binary, keep_id long, group_size long")


def exact_duplicates(docs: DataFrame, text_col: str = "text", doc_col: str = "doc_id", budget: int = BUDGET) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    small = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return digests(small).hint("merge").join(classes(small, budget), "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, text_col: str = "text", doc_col: str = "doc_id", budget: int = BUDGET) -> DataFrame:
    """``docs`` with the same columns: of each group of equal texts the kept row."""
    name = fresh(docs, "_dropped")
    gone = exact_duplicates(docs, text_col, doc_col, budget).where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(name)).distinct()
    return docs.hint("merge").join(gone, F.col(doc_col) == F.col(name), "left_anti")
