"""Helpers shared by the operators: byte-level word hashing over Arrow batches, written
lineage cuts and connected components."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.session import scratch_dir

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
PIECE = 1 << 20  # bytes hashed at once: bounds the temporaries


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: a lineage cut that
    survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    w = df.write
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker (functions pickled by value get new
    globals with each task).  Entries under a tuple go with the next ``trim``."""
    return sys.modules.setdefault("_ingot_llm_worker", types.ModuleType("_ingot_llm_worker")).__dict__


def trim() -> None:
    """Gives memory back to the system at the end of a task, that of encoders and tries which the worker kept
    from an earlier stage too: it lives on into later stages."""
    kept = worker_cache()
    for key in [k for k in kept if isinstance(k, tuple)]:
        del kept[key]
    pa.default_memory_pool().release_unused()
    if hasattr(c := ctypes.CDLL(None), "malloc_trim"):
        c.malloc_trim(0)


def of_state(cls: type, state: dict):
    """An object from its attributes.  Broadcasts carry attributes (arrays and plain values), not
    objects: they are pickled by reference, and workers need no installed copy of a class."""
    out = cls.__new__(cls)
    out.__dict__.update(state)
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    cache = worker_cache()
    if "powers" not in cache or len(cache["powers"][0]) < n:
        m = max(n, PIECE + 4096)
        p, q = np.full(m, BASE, U64), np.full(m, pow(BASE, -1, 1 << 64), U64)
        p[0] = q[0] = 1
        cache["powers"] = (np.cumprod(p), np.cumprod(q))
    return cache["powers"]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (high bits end up depending on all bits)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def lower_az() -> np.ndarray:
    """Byte table: A-Z to a-z, everything else unchanged."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def word_table(kind: str) -> np.ndarray:
    """Which UTF-8 bytes belong to a word: 'alnum' takes ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``
    (after lower-casing), 'solid' takes ``[^\\x20\\x09-\\x0D]``."""
    t = np.ones(256, dtype=bool)
    if kind == "alnum":
        t[:0x30] = t[0x3A:0x61] = t[0x7B:0x80] = False
    else:
        t[0x20] = False
        t[9:14] = False
    return t


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its len+1 offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs ``[i, j)`` of rows of at most ``limit`` bytes together, or of one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the rows: 64-bit hashes, byte starts, byte ends, and for each row (len+1) the
    index of its first word.  ``data`` is lower-cased by the caller.  Hashes are taken in pieces, so
    that their temporaries stay bounded for words of any length."""
    inside = word_table(kind)[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    if n:
        first = inside & edge[:-1]
        first[1:] |= inside[1:] & ~inside[:-1]
        last = inside & edge[1:]
        last[:-1] |= inside[:-1] & ~inside[1:]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    else:
        starts = ends = np.zeros(0, np.int64)
    hashes = np.empty(len(starts), U64)
    at = Lanes(data)
    for i in range(0, len(starts), PIECE >> 3):
        hashes[i:i + (PIECE >> 3)] = at.hashes(starts[i:i + (PIECE >> 3)], ends[i:i + (PIECE >> 3)])
    return hashes, starts, ends, np.searchsorted(starts, offsets)


class Lanes:
    """Bytes eight at a time, from any place."""

    def __init__(self, data: np.ndarray):
        self.view = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))

    def read(self, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The bytes from ``at``, eight or up to ``ends``, zeros after."""
        left = np.minimum(ends - at, 8).astype(U64)
        return self.view[at] & (~U64(0) >> (U64(64) - U64(8) * left))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the (not empty) byte runs: each eight bytes are scrambled, together with their place
        scrambled again, and summed; no run of bytes cancels another's sum, as in a polynomial."""
        size = ends - starts
        h = mix64(self.read(starts, ends))
        long = np.flatnonzero(size > 8)
        step = PIECE >> 3
        for i in range(0, len(long), step):
            w = long[i:i + step]
            more = (size[w] - 1) >> 3  # eights after the first
            head = np.cumsum(more) - more
            for a, b, j in runs(more, step):
                k = np.arange(b - a) + a - np.repeat(head[j], np.diff(np.append(np.maximum(head[j], a), b))) + 1
                own = np.repeat(j, np.diff(np.append(np.maximum(head[j], a), b)))
                x = mix64(mix64(self.read(starts[w[own]] + 8 * k, ends[w[own]])) + mix64(k.astype(U64) * U64(BASE)))
                np.add.at(h, w[j], np.add.reduceat(x, np.maximum(head[j], a) - a))
        return mix64(h + size.astype(U64) * U64(0xD6E8FEB86659FD93))


def runs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """The concatenation of runs of ``sizes`` (above 0) in pieces: begin, end, and which runs lie in it."""
    ends = np.cumsum(sizes)
    for a in range(0, int(ends[-1]) if len(ends) else 0, limit):
        b = min(a + limit, int(ends[-1]))
        yield a, b, np.arange(np.searchsorted(ends, a, side="right"), np.searchsorted(ends, b, side="left") + 1)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = np.zeros(m, U64)
    for j in range(n):
        out += hashes[j:j + m] * U64((BASE * (2 * j + 3) ^ (0xD6E8FEB86659FD93 * (j + 1))) & (1 << 64) - 1 | 1)
    return mix64(out)


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected ``edges`` (a long, b long): rows (id, component), the
    component being its smallest id.  Alternating large-star and small-star steps; each node
    only ever keeps its smallest neighbour, so a hub's edges are aggregated before the
    shuffle.  Every round is written to the shared folder; the last one changes nothing."""
    def state(e):  # the edges, whatever their order: their number and two sums of hashes
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit((1 << 31) - 1)))).first())

    e = written(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u != v").distinct()
        e = written(small, name)
        now = state(e)
        if now == before:
            break
        before = now
    return e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component").unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def in_order(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` sorted by ``keys`` across partitions and written: the result has ``part`` (the
    partition, ascending with the keys) and ``nth`` (the row's place in it).  Rows that tie on
    all keys may come in either order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    return written(parts.withColumn("nth", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), name)


def salted(*by: str, salts: int = 32):
    """The salt of a row, from the columns ``by``."""
    return F.pmod(F.xxhash64(*by), F.lit(salts))


def salted_totals(rows: DataFrame, keys: list[str], partial: list, final: list) -> DataFrame:
    """Totals per key of ``rows``, which have a column ``salt``: aggregates ``partial`` per key and salt, then
    ``final`` over these.  A row for each key and salt that occur together, so that a join on both
    spreads the rows of a hot key over as many tasks as it has salts."""
    full = rows.groupBy(*keys, "salt").agg(*partial).groupBy(*keys).agg(*final, F.collect_set("salt").alias("salt"))
    return full.withColumn("salt", F.explode("salt"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
