"""Token ids as raw binary shards with a minimal perfect hash index.

Documents are range-partitioned by doc_id; each partition streams one shard file into the
shared folder: raw little-endian ids (2 bytes where the vocabulary allows, else 4), then the
document table (key and end of each document, ascending), the index and a fixed-size footer.
The index is a minimal perfect hash over the shard's distinct keys: a few levels of bitmaps,
where a key owns the first bit that no other remaining key hits, numbered by the set bits
before it.  Each slot holds a fingerprint of its key, which rejects absent keys, and the place
of its first document.  A lookup finds its shard by the manifest's key ranges and then takes a
constant number of probes, whatever the shard's size.

A task writes under a name of its own and renames when complete, so a repeated or lost
attempt leaves either nothing or the same file.  Shards reach any store that pyarrow opens by
the scheme of ``spark.checkpoint.dir``.

Words are encoded once per worker and looked up after that (``Encoder``), which gives the ids of
the whole text for vocabularies that lower-case, drop white space and part letters from marks.
For others there is ``split_words=False``: whole texts.

Defined cases: a null text counts as empty and has only the end id; rows without a doc_id come
first; rows that share a doc_id follow each other ordered by text, and a lookup returns them
all; an empty table has no shards.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.llm.common import U64, mix64, trim, worker_cache, written
from ingot.session import scratch_dir

MAGIC = b"INGTOKS1"
FOOTER = "<8sIIQQQQqQ"  # magic, id bytes, levels, documents, ids, keys, index at, first null row or -1, null rows
MAX_CACHED, MAX_CACHED_WORD = 250_000, 64
#: How the vocabulary's splitter parts a lower-case word of Latin-1 characters: contractions,
#: letters, single digits, other marks.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00AA\u00B5\u00BA\u00DF-\u00F6\u00F8-\u00FF]+|[0-9\u00B2\u00B3\u00B9\u00BC-\u00BE]"
                    "|[^\t\n\x0b\x0c\r \u0085\u00A00-9a-z\u00AA\u00B5\u00BA\u00DF-\u00F6\u00F8-\u00FF\u00B2\u00B3\u00B9\u00BC-\u00BE]+")
#: Where the short way does not hold: a mark before a full stop or comma joins it, and special
#: tokens are found before lower-casing.
UNCLEAR = re.compile(r"[.,][ \n](?<=(?:[^\w\s]|[_\x1c-\x1f])..)", re.S)  # begins with a few characters, so that the others are passed over


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet of public BPE vocabularies: printable bytes stand for
    themselves, the others for the characters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts as bytes, through a table of the words met so far.

    Texts of Latin-1 characters take the short way: lower-cased, full stops and commas at the
    ends of words set apart, split at spaces and line feeds.  That is what the vocabulary's
    normaliser and splitter do there, so words can be encoded one by one, and their pieces go
    straight to the vocabulary's model.  Other texts are split at spaces only, and each word
    runs through the whole tokenizer.

    The table has two generations: a full one becomes the old one, and words in use move to
    the new one, so frequent words stay while memory is bounded."""

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer, self.type = Tokenizer.from_file(path), np.dtype(f"<u{width}")
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.raw = [i.to_bytes(width, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.tables = {True: ({}, {}), False: ({}, {})}  # by way: new and old generation

    def plain(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, self.type).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def piece(self, w: str) -> bytes:
        """The ids of one piece (lower-case Latin-1 letters, a digit, or marks)."""
        x = w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.raw[t.id] for t in self.model.tokenize(x)])

    def learn(self, words: set[str], short: bool) -> dict[str, bytes]:
        """The ids of words that the new generation lacks; kept unless long."""
        known, old = self.tables[short]
        out = {}
        for w in words:
            if w in old:
                out[w] = old[w]
            elif short and w.isascii() and w.isalpha():  # one piece
                out[w] = self.piece(w)
            elif short:
                out[w] = b"".join([known[x] if x in known else self.piece(x) for x in PIECES.findall(w)])
        if not short:
            rest = [w for w in words if w not in out]
            out.update(zip(rest, self.plain(rest)))
        if len(known) + len(out) > MAX_CACHED:
            self.tables[short] = known, old = {}, known
        known.update((w, x) for w, x in out.items() if len(w) <= MAX_CACHED_WORD)
        return out

    def __call__(self, text: str) -> bytes:
        short = text.isascii() or latin(text)
        if short and "<|" not in text and not UNCLEAR.search(text):
            low = text.lower().replace("\n", " ")
            parts = low.replace(". ", " . ").replace(", ", " , ").split(" ")
        else:
            short, parts = False, text.replace("\n", " ").split(" ")
        out = list(map(self.tables[short][0].get, parts))
        if lacking := places(out, None):
            new = self.learn({parts[i] for i in lacking}, short)
            for i in lacking:
                out[i] = new[parts[i]]
        return b"".join(out)


def places(values: list, x) -> list[int]:
    """Where ``x`` is in the list."""
    out, i = [], -1
    try:
        while True:
            out.append(i := values.index(x, i + 1))
    except ValueError:
        return out


def latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def encoder(path: str, width: int, split_words: bool = True):
    cache = worker_cache()
    if ("encoder", path, width) not in cache:
        cache["encoder", path, width] = Encoder(path, width)
    own = cache["encoder", path, width]
    return own if split_words else lambda text: own.plain([text])[0]


def level_bit(h: np.ndarray, level: int, bits: int) -> np.ndarray:
    return mix64(h + U64((0x9E3779B97F4A7C15 * (level + 1)) & ((1 << 64) - 1))) % U64(bits)


def fingerprints(h: np.ndarray) -> np.ndarray:
    return (mix64(h ^ U64(0xD6E8FEB86659FD93)) >> U64(32)).astype(np.uint32)


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit values: level bitmaps and the set bits before
    each of their words."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        words = np.concatenate(levels) if levels else np.zeros(0, U64)
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
        at = np.cumsum([0, *map(len, levels)])
        self.before = [before[a:b] for a, b in zip(at[:-1], at[1:])]

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        levels = []
        while len(h):
            bits = 64 * max(1, -(-2 * len(h) // 64))
            pos = level_bit(h, len(levels), bits).astype(np.int64)
            alone = np.bincount(pos, minlength=bits)[pos] == 1
            words = np.zeros(bits // 64, U64)
            np.bitwise_or.at(words, pos[alone] >> 6, U64(1) << (pos[alone] & 63).astype(U64))
            levels.append(words)
            h = h[~alone]
        return cls(levels)

    def slots(self, h: np.ndarray) -> np.ndarray:
        """The slot of each value; -1 where no level has its bit."""
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for k, words in enumerate(self.levels):
            pos = level_bit(h[left], k, 64 * len(words))
            word, bit = (pos >> U64(6)).astype(np.int64), pos & U64(63)
            hit = (words[word] >> bit) & U64(1) == 1
            below = words[word] & ((U64(1) << bit) - U64(1))
            out[left[hit]] = (self.before[k][word] + np.bitwise_count(below).astype(np.int64))[hit]
            left = left[~hit]
        return out


class ShardWriter:
    def __init__(self, base: str, part: int, width: int):
        self.fs, self.base = opened(base)
        self.fs.create_dir(self.base, recursive=True)
        self.name, self.width = f"shard-{part:06d}.ids", width
        self.temp = f"{self.base}/_{self.name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temp)
        self.keys, self.sizes = [], []

    def add(self, key: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.keys.append(key)
        self.sizes.append(len(ids) // self.width)

    def close(self) -> tuple[str, int, int]:
        """Index and footer, then the shard's final name: name, documents, ids."""
        nulls = sum(k is None for k in self.keys)  # they come first
        keys = np.array([k or 0 for k in self.keys], np.int64)
        ends = np.cumsum(np.array(self.sizes, np.int64))
        at = np.arange(nulls, len(keys))
        first = at[np.concatenate([[True], keys[at][1:] != keys[at][:-1]])] if len(at) else at
        h = mix64(keys[first].view(U64))
        mph = PerfectHash.build(h)
        slot = mph.slots(h)
        finger, row = np.zeros(len(h), np.uint32), np.zeros(len(h), np.int64)
        finger[slot], row[slot] = fingerprints(h), first
        n_ids = int(ends[-1]) if len(ends) else 0
        pad = -n_ids * self.width % 8
        for x in (b"\0" * pad, keys.tobytes(), ends.tobytes(), np.array([len(w) for w in mph.levels], np.int64).tobytes(),
                  *(w.tobytes() for w in mph.levels), row.tobytes(), finger.tobytes(),
                  struct.pack(FOOTER, MAGIC, self.width, len(mph.levels), len(keys), n_ids, len(h), n_ids * self.width + pad, 0 if nulls else -1, nulls)):
            self.out.write(x)
        self.out.close()
        self.fs.move(self.temp, f"{self.base}/{self.name}")
        return self.name, len(keys), n_ids


class Shard:
    """A shard file: its document table and index in memory, ids read as they are asked for."""

    def __init__(self, base: str, name: str):
        fs, path = opened(base)
        self.file = fs.open_input_file(f"{path}/{name}")
        size = self.file.size()
        magic, self.width, n_levels, n, self.n_ids, n_keys, at, _, self.nulls = struct.unpack(FOOTER, self.file.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER)))
        if magic != MAGIC:
            raise ValueError(f"{name}: not a token shard")
        data = self.file.read_at(size - struct.calcsize(FOOTER) - at, at)
        self.keys, self.ends = np.frombuffer(data, np.int64, n), np.frombuffer(data, np.int64, n, 8 * n)
        pos, levels = 16 * n + 8 * n_levels, []
        for k in np.frombuffer(data, np.int64, n_levels, 16 * n).tolist():
            levels.append(np.frombuffer(data, U64, k, pos))
            pos += 8 * k
        self.hash = PerfectHash(levels)
        self.row, self.finger = np.frombuffer(data, np.int64, n_keys, pos), np.frombuffer(data, np.uint32, n_keys, pos + 8 * n_keys)

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids of the documents in rows a..b-1."""
        start = int(self.ends[a - 1]) if a else 0
        return np.frombuffer(self.file.read_at((int(self.ends[b - 1]) - start) * self.width, start * self.width), f"<u{self.width}")

    def get(self, key: int | None) -> list[np.ndarray]:
        """The ids of each document with this key; none if it is absent."""
        if key is None:
            return [self.ids(r, r + 1) for r in range(self.nulls)]
        h = mix64(np.array([key], np.int64).view(U64))
        slot = int(self.hash.slots(h)[0])
        if slot < 0 or self.finger[slot] != fingerprints(h)[0] or self.keys[self.row[slot]] != key:
            return []
        out, r = [], int(self.row[slot])
        while r < len(self.keys) and self.keys[r] == key:
            out.append(self.ids(r, r + 1))
            r += 1
        return out


MANIFEST = "part int, name string, low long, high long, nulls long, n_docs long, n_ids long"


def write_shards(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int, text_col: str = "text", doc_col: str = "doc_id",
                 base: str | None = None, split_words: bool = True) -> tuple[str, DataFrame]:
    """Writes the shards of ``docs``; the folder and the manifest (a row per shard, written)."""
    base = base or scratch_dir(docs.sparkSession, "token-shards")
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    rows = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        from pyspark import TaskContext

        part, out, keys = TaskContext.get().partitionId(), None, []
        end, encode = np.array([end_id], f"<u{width}").tobytes(), encoder(tokenizer, width, split_words)
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = ShardWriter(base, part, width)
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                out.add(key, encode(text.as_py() or "") + end)
        if out is not None:
            keys = [k for k in (out.keys[0], out.keys[-1], next((k for k in out.keys if k is not None), None))]
            name, n, ids = out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "name": name, "low": keys[2], "high": keys[1], "nulls": sum(k is None for k in out.keys), "n_docs": n, "n_ids": ids}],
                                             pa.schema([("part", pa.int32()), *((c, pa.string() if c == "name" else pa.int64()) for c in ("name", "low", "high", "nulls", "n_docs", "n_ids"))]))

    return base, written(rows.mapInArrow(run, MANIFEST), "token-manifest")


def placed(manifest: DataFrame) -> list:
    """The manifest's rows in key order, each with the ids of all shards before it."""
    out, start = [], 0
    for r in sorted(manifest.collect(), key=lambda r: r["part"]):
        out.append((r["name"], start, r["low"], r["high"], r["nulls"]))
        start += r["n_ids"]
    return out


def read_shards(spark: SparkSession, base: str, manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    shards = placed(manifest)
    # a task per shard
    rows = spark.createDataFrame(spark.sparkContext.parallelize([(n, s) for n, s, *_ in shards], max(1, len(shards))), "name string, start long")

    def run(batches):
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(base, name)
                a, n = 0, len(shard.keys)
                while a < n:  # documents of about a million ids at a time
                    begin = int(shard.ends[a - 1]) if a else 0
                    b = min(n, max(a + 1, int(np.searchsorted(shard.ends, begin + (1 << 20), side="right"))))
                    ids = shard.ids(a, b).astype("<u4")
                    ends = shard.ends[a:b] - begin
                    starts = np.concatenate([[0], ends[:-1]])
                    crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([None if r < shard.nulls else int(k) for r, k in enumerate(shard.keys[a:b], a)], pa.int64()),
                        pa.array(starts + begin + start, pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])
                    a = b
        trim()  # the encoder that the worker kept from the writing is not needed any more

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(keys: DataFrame, base: str, manifest: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """Keyed access: for each key a row (doc_id, ids) per document that has it."""
    shards = [(n, low, high) for n, _, low, high, _ in placed(manifest) if low is not None]
    shipped = keys.sparkSession.sparkContext.broadcast(shards)  # a row per shard

    def run(batches):
        lows = [low for _, low, _ in shipped.value]
        opened_, out_k, out_v = {}, [], []
        for batch in batches:
            for k in batch.column(0).to_pylist():
                i = int(np.searchsorted(lows, k, side="right")) - 1 if k is not None else -1
                if i >= 0 and k <= shipped.value[i][2]:
                    if i not in opened_:
                        opened_ = {i: Shard(base, shipped.value[i][0])}
                    for ids in opened_[i].get(k):
                        out_k.append(k)
                        out_v.append(ids.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(out_k, pa.int64()), pa.array(out_v, pa.list_(pa.int64()))], names=["doc_id", "ids"])
            out_k, out_v = [], []

    return keys.select(F.col(key_col).cast("long").alias("doc_id")).sort("doc_id").mapInArrow(run, "doc_id long, ids array<long>")


def token_table(docs: DataFrame, tokenizer: str | None = None, vocabulary: int = 49408, end_id: int = 1) -> DataFrame:
    """Writes the shards of ``docs`` and reads them back (``read_shards``)."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    base, manifest = write_shards(docs, str(tokenizer), vocabulary, end_id)
    return read_shards(docs.sparkSession, base, manifest)
