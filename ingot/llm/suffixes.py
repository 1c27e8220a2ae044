"""Suffix-array dedup of long byte strings across the corpus.

Removed is every byte covered by a string of ``length`` bytes that also starts earlier (at a
smaller doc_id, or earlier in the document).

Dealing the corpus.  Each string of ``length`` bytes has an anchor: of its k-grams the one with
the smallest hash, the leftmost of equals.  Equal strings have equal anchors at equal places, so
they meet when strings are dealt by anchor.  Consecutive strings with one anchor form a segment;
a segment is dealt as two hashes (anchor, content) first.  Documents are held in chunks of a few
megabytes, and equal segments of a chunk are folded before they are dealt, so a text that fills
a third of the corpus is dealt once per chunk.

Deciding.  A segment whose content starts earlier elsewhere is marked whole.  Only where
one anchor has different contents (the rims of repeats) is more needed: the first occurrence
of each content ships its bytes, and the shipped contents of an anchor are suffix-sorted by
the linear grouping construction (``gsaca``).  They are sorted as sequences of 8-byte symbols
aligned with the anchor; neighbours in the order that agree in all whole symbols of a string,
and exactly in the up to 12 bytes at its ends, are equal strings, and all but the earliest are
marked.  An anchor with more than ``hot`` contents deals its strings one by one by content
instead, so no group grows with the corpus.

Matches never cross documents.  Defined cases: null counts as empty; texts shorter than
``length`` keep all bytes; rows that share a doc_id count as one after the other, ordered by
text; a missing doc_id comes first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ingot.llm.common import PIECE, U64, as_long, mix64, powers, utf8
from ingot.llm.gsaca import suffix_order

GRAM, WORD = 32, 8
CHUNK_BYTES, SORT_BYTES = 4 << 20, 2 << 20


def segments(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The segments of some documents: start, number of strings, anchor place, anchor hash,
    content hash; in text order."""
    out = []
    width = length - GRAM + 1
    valid = np.ones(max(0, len(data) - length + 1), bool)
    for e in offsets[1:].tolist():
        valid[max(0, e - length + 1):e] = False
    starts = offsets[:-1][np.diff(offsets) < length]
    for s, e in zip(starts.tolist(), offsets[1:][np.diff(offsets) < length].tolist()):
        valid[s:e] = False
    low = U64((1 << 21) - 1)
    for a in range(0, len(valid), PIECE):
        b = min(len(valid), a + PIECE)
        if not valid[a:b].any():
            continue
        piece = data[a:b + length - 1]
        p, q = powers(len(piece) + 1)
        total = np.empty(len(piece) + 1, U64)
        total[0] = 0
        np.cumsum((piece.astype(U64) + U64(1)) * p[:len(piece)], out=total[1:])
        gram = mix64((total[GRAM:] - total[:-GRAM]) * q[:len(piece) - GRAM + 1])
        least = (gram & ~low) | np.arange(len(gram), dtype=U64)
        span = 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if width > span:
            least = np.minimum(least[:-(width - span)], least[width - span:])
        anchor = (least & low).astype(np.int64)
        ok = valid[a:b]
        cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (ok[1:] != ok[:-1])]))
        n = np.diff(np.append(cut, b - a))
        cut, n = cut[ok[cut]], n[ok[cut]]
        at = anchor[cut]
        end = cut + n + length - 1
        content = mix64(((total[end] - total[cut]) * q[cut]) ^ mix64(n.astype(U64)))
        out.append((cut + a, n, at + a, gram[at], content))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, U64, U64))
    return tuple(map(np.concatenate, zip(*out)))


def opened(docs: pa.Table, length: int):
    """A chunk's documents in order: doc_id (None for missing), bytes, offsets and segments."""
    docs = docs.select(["doc_id", "text"]).combine_chunks()
    ids, text = docs.column(0), docs.column(1)
    order = pa.compute.sort_indices(docs, sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start")
    text = text.take(order)
    data, offsets = utf8(text)
    return ids.take(order).to_pylist(), data, offsets, segments(data, offsets, length)


def folded(anchor: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Whether a segment is the chunk's first with its anchor and content."""
    first = np.zeros(len(anchor), bool)
    order = np.lexsort((content, anchor))
    a, c = anchor[order], content[order]
    if len(order):
        first[order[np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])])]] = True
    return first


NO_ID = -(1 << 63)


def doc_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, starts, side="right") - 1


def repeats(contents: list[bytes], anchors: list[int], length: int) -> list[np.ndarray]:
    """For the contents of some anchors' segments (of one anchor in text order): which of a
    segment's strings also occur in an earlier segment."""
    size = np.array([len(c) for c in contents], np.int64)
    n = size - length + 1
    base = np.array(anchors, np.int64) % WORD  # the first symbol's place in the content
    count = (size - base) // WORD
    data = np.frombuffer(b"".join(contents), np.uint8)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    # symbols: all segments one after the other, a separator (0) behind each
    room = count + 1
    at = np.concatenate([[0], np.cumsum(room)[:-1]])
    seg = np.repeat(np.arange(len(size)), count)
    k = np.arange(len(seg)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    pos = (begin + base)[seg] + k * WORD
    symbol = np.zeros(len(seg), U64)
    for t in range(WORD):
        symbol |= data[pos + t].astype(U64) << U64(8 * t)
    text = np.zeros(int(room.sum()), np.int64)
    text[at[seg] + k] = np.unique(symbol, return_inverse=True)[1] + 1
    order = suffix_order(text)
    whole = (length - WORD + 1) // WORD  # symbols that lie in a string wherever it starts
    padded = np.concatenate([text, np.full(whole, -1)])
    same = np.ones(len(order) - 1, bool)
    for t in range(whole):
        same &= padded[order[1:] + t] == padded[order[:-1] + t]
    cls = np.empty(len(order), np.int64)
    cls[order] = np.concatenate([[0], np.cumsum(~same)])
    # every string: its class, and the bytes before and behind its whole symbols
    seg = np.repeat(np.arange(len(size)), n)
    s = np.arange(len(seg)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    lead = (base[seg] - s) % WORD
    c = cls[at[seg] + (s + lead - base[seg]) // WORD]
    start, rest = begin[seg] + s, length - WORD * whole
    keys = [c]
    for t0 in range(0, rest, 7):
        key = np.zeros(len(seg), np.int64)
        for t in range(t0, min(rest, t0 + 7)):
            key = key << 8 | data[start + np.where(t < lead, t, t + WORD * whole)]
        keys.append(key)
    order = np.lexsort(keys[::-1] + [])
    first = np.zeros(len(seg), bool)
    first[0] = True
    for key in keys:
        first[1:] |= key[order][1:] != key[order][:-1]
    marked = np.zeros(len(seg), bool)
    marked[order] = ~first
    return np.split(marked, np.cumsum(n)[:-1])


SHIPPED = "bucket long, chunk long, doc_id long, seq long, strings long, anchor long, content binary, whole binary"
SHIPPED_TYPES = [pa.int64()] * 6 + [pa.binary()] * 2
SHIPPED_NAMES = ["bucket", "chunk", "doc_id", "seq", "strings", "anchor", "content", "whole"]
MARKS = "chunk long, seq long, first long, mask binary"


def dedup(docs: DataFrame, length: int = 100, hot: int = 20_000, text_col: str = "text", doc_col: str = "doc_id",
          chunk_bytes: int = CHUNK_BYTES, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for,
    ``kept`` (binary: a removed run may begin or end within a character)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    rows = docs.select(F.pmod(F.xxhash64(F.col(doc_col)), F.lit(chunks)).alias("chunk"), F.col(doc_col).cast("long").alias("doc_id"), text.alias("text"))

    def first_segments(t: pa.Table) -> pa.Table:
        ids, _, offsets, (start, _, _, anchor, content) = opened(t, length)
        seq = np.flatnonzero(folded(anchor, content))
        keys = np.array([NO_ID if i is None else i for i in ids], np.int64)
        return pa.table({"anchor": as_long(anchor[seq]), "content": as_long(content[seq]), "doc_id": keys[doc_of(start[seq], offsets)], "seq": seq})

    dealt = rows.groupBy("chunk").applyInArrow(first_segments, "anchor long, content long, doc_id long, seq long")
    by_content = Window.partitionBy("anchor").orderBy("content", "doc_id", "seq")
    x = dealt.withColumn("new", F.coalesce(F.lag("content").over(by_content) != F.col("content"), F.lit(True)))
    x = x.withColumn("contents", F.sum(F.col("new").cast("long")).over(Window.partitionBy("anchor")))
    state = F.when(~F.col("new"), 1).when(F.col("contents") == 1, 0).when(F.col("contents") <= hot, 2).otherwise(3)
    own = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    flags = x.withColumn("state", state).where("state > 0").select(F.pmod(F.xxhash64(own), F.lit(chunks)).alias("chunk"), "seq", "state")

    def ship(t: pa.Table, f: pa.Table) -> pa.Table:
        out = []
        if f.num_rows:
            chunk = f.column("chunk")[0].as_py()
            ids, data, offsets, (start, n, at, anchor, _) = opened(t, length)
            seq, state = f.column("seq").to_numpy(), f.column("state").to_numpy()
            whole = np.sort(seq[state == 1])
            out.append((chunk, chunk, None, -1, 0, 0, None, whole.astype(np.int64).tobytes()))
            buf, doc = data.tobytes(), doc_of(start, offsets)
            for k in seq[state == 2].tolist():
                s, m = int(start[k]), int(n[k])
                out.append((int(as_long(anchor[k:k + 1])[0]), chunk, ids[doc[k]] if ids[doc[k]] is not None else NO_ID, k, m, int(at[k]) - s, buf[s:s + m + length - 1], None))
            for k in seq[state == 3].tolist():  # one row for each string, dealt by its content
                for s in range(int(start[k]), int(start[k] + n[k])):
                    x = buf[s:s + length]
                    out.append((int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True), chunk,
                                ids[doc[k]] if ids[doc[k]] is not None else NO_ID, k, s - int(start[k]), -1, x, None))
        return pa.table([pa.array(c, t_) for c, t_ in zip(zip(*out) if out else [[]] * 8, SHIPPED_TYPES)], names=SHIPPED_NAMES)

    shipped = rows.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(ship, SHIPPED)
    shipped = shipped.repartition("bucket").sortWithinPartitions("bucket", F.col("anchor") >= 0, "doc_id", "seq", "strings")

    def decide(batches):
        def rows_out(out):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)] + [pa.array([r[3] for r in out], pa.binary())],
                                              names=["chunk", "seq", "first", "mask"])

        def settled():
            if not held:
                return []
            masks = repeats([h[3] for h in held], [h[2] for h in held], length)
            return [(h[0], h[1], 0, np.packbits(m).tobytes()) for h, m in zip(held, masks) if m.any()]

        held, size, last, earlier, ready = [], 0, None, set(), []
        for batch in batches:
            for bucket, chunk, _, seq, strings, anchor, content, whole in zip(*(c.to_pylist() for c in batch.columns)):
                if whole is not None:
                    ready.append((chunk, -1, 0, whole))
                elif anchor < 0:
                    if last is None or last != bucket:
                        earlier = set()
                    last = bucket
                    if content in earlier:
                        ready.append((chunk, seq, strings, b"\x80"))
                    earlier.add(content)
                else:
                    if size > SORT_BYTES and bucket != held[-1][4]:
                        ready += settled()
                        held, size = [], 0
                    held.append((chunk, seq, anchor, content, bucket))
                    size += len(content)
                if len(ready) > 20_000 or whole is not None:
                    yield rows_out(ready)
                    ready = []
        yield rows_out(ready + settled())

    marks = shipped.mapInArrow(decide, MARKS)

    def finish(t: pa.Table, m: pa.Table) -> pa.Table:
        ids, data, offsets, (start, n, _, anchor, content) = opened(t, length)
        mark = ~folded(anchor, content)
        cover = np.zeros(len(data) + 1, np.int32)
        for seq, first, mask in zip(*(m.column(c).to_pylist() for c in ("seq", "first", "mask"))):
            if seq < 0:
                mark[np.frombuffer(mask, np.int64)] = True
            else:
                hit = start[seq] + first + np.flatnonzero(np.unpackbits(np.frombuffer(mask, np.uint8)))
                cover[hit] += 1
                cover[hit + length] -= 1
        np.add.at(cover, start[mark], 1)
        np.add.at(cover, start[mark] + n[mark] + length - 1, -1)
        gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins = gone & (edge[:-1] | ~np.concatenate([[False], gone[:-1]])) if len(gone) else gone
        removed, spans = (np.concatenate([[0], np.cumsum(v)])[offsets] for v in (gone, begins))
        kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        out = {"doc_id": pa.array(ids, pa.int64()), "n_bytes": np.diff(offsets), "n_removed": np.diff(removed), "n_spans": np.diff(spans),
               "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())}
        return pa.table(out | ({"kept": pa.array(kept, pa.binary())} if with_text else {}))

    # the marks' chunks all have documents
    return rows.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else ""))
