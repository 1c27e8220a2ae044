"""WARC archives: writing page captures, reading records back, transaction assembly.

``write_archive`` writes three records per page (request; response or revisit; metadata), one gzip
member each, the request and the metadata naming their response in ``WARC-Concurrent-To``.  Of
pages with equal payloads of at least ``min_bytes`` bytes one is the response, that with the
smallest key, and the others are revisits that refer to it and hold no payload.  ``read_records``
streams any archive, gzip or plain, into a row per record.  ``assemble`` joins the records of a
transaction through their concurrent-to identifiers, whichever side names the other and over any
number of steps, and gives one nested row per capture.

Equal payloads are found by SHA-256.  Payloads are shuffled once, by page and digest, so that a
payload that a third of the pages share is spread over all tasks; the groups are aggregated from
keys and digests before they are joined.

Defined cases: a null payload is empty; a null key sorts after all others and stays null; a null url
leaves the target uri out; of pages that agree in key, url and payload one counts as the first, so a
group has exactly one response; an empty table gives an archive without files.  Control
characters and spaces in urls are percent-encoded in the header lines.  A record cut short or without
a WARC header ends the job with the file's name; a payload that does not fit its digest is read and
marked ``intact = false``.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ingot.llm.common import salted, salted_totals, written
from ingot.llm.tokens import opened
from ingot.session import scratch_dir

FILE_BYTES = 1 << 30  # a larger file is closed and the next one begun
CAPTURES = ("response", "revisit", "resource")
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "name string, n_records long, n_bytes long"
RECORD = ("file string, nth long, record_id string, type string, concurrent_to array<string>, target_uri string, date string, refers_to string, "
          "http_status int, fields array<struct<name string, value string>>, payload_bytes long, payload_digest string, intact boolean")


def identifier(*of) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join(map(str, of)).encode()).digest()[:16])}>"


def uri(text: str) -> str:
    """``text`` as the value of a header line."""
    return quote(text, safe="".join(map(chr, range(33, 127))), errors="replace")


class ArchiveWriter:
    """Files ``<name>-<k>.warc.gz`` of one task; each gets its final name when it is complete."""

    def __init__(self, base: str, part: int, date: str, file_bytes: int):
        self.fs, self.base = opened(base)
        self.fs.create_dir(self.base, recursive=True)
        self.part, self.date, self.file_bytes, self.files, self.out = part, date, file_bytes, [], None

    def record(self, type_: str, record_id: str, headers: list[tuple[str, str]], block: bytes) -> None:
        if self.out is None:
            self.name = f"pages-{self.part:06d}-{len(self.files):04d}.warc.gz"
            self.temp = f"{self.base}/_{self.name}.{uuid.uuid4().hex}"
            self.out, self.n, self.size = self.fs.open_output_stream(self.temp, compression=None), 0, 0
            self.record("warcinfo", identifier(self.name), [("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
        lines = [("WARC-Type", type_), ("WARC-Record-ID", record_id), ("WARC-Date", self.date), *headers, ("Content-Length", str(len(block)))]
        head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
        data = gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)
        self.out.write(data)
        self.n, self.size = self.n + 1, self.size + len(data)

    def page(self, key: str | None, url: str | None, payload: bytes, n: int, digest: str, record_id: str, refers: str | None, refers_key: str | None, refers_url: str | None) -> None:
        if self.out is not None and self.size >= self.file_bytes:
            self.close()
        target = [("WARC-Target-URI", uri(url))] if url is not None else []
        rest = (url or "").split("://", 1)[-1]
        host, slash, path = rest.partition("/")
        request = f"GET {uri(slash + path) or '/'} HTTP/1.1\r\nHost: {uri(host)}\r\n\r\n".encode()
        self.record("request", identifier(record_id, "request"), [*target, ("WARC-Concurrent-To", record_id), ("Content-Type", "application/http; msgtype=request")], request)
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
        said = [*target, ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
        if refers is None:
            self.record("response", record_id, said, http + payload)
        else:
            of = [("WARC-Refers-To", refers), *([("WARC-Refers-To-Target-URI", uri(refers_url))] if refers_url is not None else [])]
            self.record("revisit", record_id, [*said, ("WARC-Profile", IDENTICAL), *of], http)
        about = [("key", key), ("refers-to-key", refers_key)]
        fields = "".join(f"{k}: {quote(v, errors='replace')}\r\n" for k, v in about if v is not None)
        self.record("metadata", identifier(record_id, "metadata"), [*target, ("WARC-Concurrent-To", record_id), ("Content-Type", "application/warc-fields")], fields.encode())

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temp, f"{self.base}/{self.name}")
            self.files.append((self.name, self.n, self.size))
            self.out = None


def write_archive(pages: DataFrame, base: str | None = None, key: str = "page_id", url: str = "url", payload: str = "html",
                  date: str = "2000-01-01T00:00:00Z", min_bytes: int = 100, file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Writes the pages to archives in the folder ``base`` (a scratch folder if not given); the folder
    and the manifest (name, n_records, n_bytes; written)."""
    base = base or scratch_dir(pages.sparkSession, "warc")
    raw = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), raw.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("n"), F.sha2("payload", 256).alias("digest"), F.sha2(F.to_json(F.struct("key", "url")), 256).alias("page"))
    keys = rows.where(F.col("n") >= min_bytes).select("key", "url", "page", "digest", salted("page").alias("salt"))
    first = salted_totals(keys, ["digest"], [F.min(F.struct(F.col("key").isNull(), "key", "page", "url")).alias("first"), F.count("*").alias("size")],
                          [F.min("first").alias("first"), F.sum("size").alias("size")]).where("size > 1")
    refers = keys.groupBy("digest", "salt", "page").agg(F.lit(1)).join(first, ["digest", "salt"]).select(
        "digest", "page", F.col("first.page").alias("of"), F.col("first.key").cast("string").alias("refers_key"), F.col("first.url").alias("refers_url"))
    rows = rows.join(refers.hint("merge"), ["digest", "page"], "left")
    nth = F.row_number().over(Window.partitionBy("digest", "page").orderBy("n"))
    rows = rows.withColumn("nth", nth).select(F.col("key").cast("string").alias("key"), "url", "payload", "n", "digest", "page", "nth", "of", "refers_key", "refers_url")

    def run(batches):
        from pyspark import TaskContext

        out = ArchiveWriter(base, TaskContext.get().partitionId(), date, file_bytes)
        for batch in batches:
            head = zip(*(batch.column(i).to_pylist() for i in range(3, 10)))
            for i, (n, digest, page, nth, of, refers_key, refers_url) in enumerate(head):
                key, url, payload = (batch.column(c)[i].as_py() for c in range(3))
                own = of is None or (of == page and nth == 1)
                out.page(key, url, payload, n, digest, identifier(page, digest, nth),
                         None if own else identifier(of, digest, 1), None if own else refers_key, None if own else refers_url)
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in out.files], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["name", "n_records", "n_bytes"])

    return base, written(rows.mapInArrow(run, MANIFEST), "warc-manifest")


def pairs(lines: list[bytes]) -> list[tuple[str, str]]:
    out = []
    for line in lines:
        if line[:1] in b" \t" and out:  # a folded line
            out[-1] = (out[-1][0], out[-1][1] + " " + line.decode("utf-8", "replace").strip())
        else:
            k, _, v = line.decode("utf-8", "replace").partition(":")
            out.append((k.strip().lower(), v.strip()))
    return out


def head_lines(stream, name: str) -> list[bytes]:
    lines = []
    while True:
        line = stream.readline()
        if not line:
            raise ValueError(f"{name}: a record is cut short")
        line = line.rstrip(b"\r\n")
        if not line:
            return lines
        lines.append(line)


def parsed(stream, name: str):
    """The records of an open archive: type, header pairs, block."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no WARC record at {line[:20]!r}")
        head = pairs(head_lines(stream, name))
        one = dict(reversed(head))
        size = int(one.get("content-length", 0))
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"{name}: a record is cut short")
        yield one.get("warc-type"), head, one, block


def content(type_: str, one: dict, block: bytes) -> tuple[int | None, list[tuple[str, str]], bytes]:
    """HTTP status, HTTP headers or warc-fields, payload of a block."""
    kind = one.get("content-type", "")
    if kind.startswith("application/warc-fields"):
        return None, [(k, unquote(v)) for k, v in pairs([x for x in block.split(b"\r\n") if x])], block
    if not kind.startswith("application/http"):
        return None, [], block
    head, _, payload = block.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    words = first.split()
    status = int(words[1]) if type_ != "request" and len(words) > 1 and words[1].isdigit() else None
    return status, pairs(lines), payload


def read_records(spark: SparkSession, base: str, files: DataFrame, payload: bool = False) -> DataFrame:
    """A row per record (``RECORD``) of the archives ``files`` (name) in ``base``, a task per file; with
    ``payload`` also its bytes.  A revisit has the size and digest of the payload that it leaves out."""
    names = files.select("name").repartition(max(1, files.count()))
    schema = RECORD + (", payload binary" if payload else "")
    arrow = pa.schema([("file", pa.string()), ("nth", pa.int64()), ("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("target_uri", pa.string()),
                       ("date", pa.string()), ("refers_to", pa.string()), ("http_status", pa.int32()), ("fields", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
                       ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_()), *([("payload", pa.binary())] if payload else [])])

    def rows(name):
        fs, path = opened(base)
        with fs.open_input_stream(f"{path}/{name}", compression=None) as raw:
            raw = io.BufferedReader(raw, 1 << 20)
            stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18) if raw.peek(2)[:2] == b"\x1f\x8b" else raw
            for nth, (type_, head, one, block) in enumerate(parsed(stream, name)):
                status, fields, body = content(type_, one, block)
                n, digest, said = len(body), hashlib.sha256(body).hexdigest(), one.get("warc-payload-digest", "").removeprefix("sha256:").lower() or None
                intact = said is None or len(said) != 64 or said == digest
                if type_ == "revisit":
                    length = dict(fields).get("content-length", "")
                    n, digest, intact = int(length) if length.isdigit() else None, said, True
                r = {"file": name, "nth": nth, "record_id": one.get("warc-record-id"), "type": type_, "concurrent_to": [v for k, v in head if k == "warc-concurrent-to"],
                     "target_uri": one.get("warc-target-uri"), "date": one.get("warc-date"), "refers_to": one.get("warc-refers-to"), "http_status": status,
                     "fields": [{"name": k, "value": v} for k, v in fields], "payload_bytes": n, "payload_digest": digest, "intact": intact}
                yield r | ({"payload": body} if payload else {}), len(block)

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out, size = [], 0
                for r, n in rows(name):
                    out.append(r)
                    size += n if payload else 0
                    if len(out) == 4096 or size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(out, arrow)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, arrow)

    return names.mapInArrow(run, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture (response, revisit or resource) of ``records`` (read_records; read
    several times, so written or cheap): its own columns, ``requests`` and ``metadata``, arrays of structs of the
    records that are concurrent to it, directly or through others of its transaction, by record id.
    A record that is concurrent to several captures is in each; one without a capture is in none."""
    captures = records.where(F.col("type").isin(*CAPTURES))
    sides = records.where(F.col("type").isin("request", "metadata"))
    link = records.where(F.size("concurrent_to") > 0).select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    # edges that lead to a request or a metadata record
    links = link.unionByName(link.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().join(sides.select(F.col("record_id").alias("b")).distinct(), "b", "left_semi")
    links = written(links, "warc-links")
    reached = new = written(links.join(captures.select(F.col("record_id").alias("a")), "a").select(F.col("b").alias("record_id"), F.col("a").alias("capture")).distinct(), "warc-reached")
    inner = links.join(sides.select(F.col("record_id").alias("a")).distinct(), "a", "left_semi")  # steps between sides
    while not inner.isEmpty():
        step = inner.join(new.withColumnRenamed("record_id", "a"), "a").select(F.col("b").alias("record_id"), "capture").distinct()
        new = written(step.join(reached, ["record_id", "capture"], "left_anti"), "warc-reached")
        if new.isEmpty():
            break
        reached = reached.unionByName(new)
    kept = [c for c in records.columns if c not in ("file", "nth", "type")]
    of = sides.join(reached, "record_id").groupBy("capture").agg(
        *[F.sort_array(F.collect_list(F.when(F.col("type") == t, F.struct(*kept)))).alias(name) for t, name in (("request", "requests"), ("metadata", "metadata"))])
    none = F.array().cast(of.schema["requests"].dataType)
    return captures.join(of.withColumnRenamed("capture", "record_id"), "record_id", "left").withColumns({c: F.coalesce(c, none) for c in ("requests", "metadata")})


def field(array: str, name: str):
    """The first value called ``name`` among the fields of a capture's first record in ``array``."""
    found = F.filter(F.coalesce(F.get(F.col(array), 0).getField("fields"), F.array().cast("array<struct<name string, value string>>")), lambda x: x["name"] == name)
    return F.get(found, 0).getField("value")


def archived(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Writes ``pages`` (page_id, url, html), reads the archives back and assembles them: page_id,
    payload_bytes, payload_digest, record_type, refers_to, intact, n_requests."""
    base, manifest = write_archive(pages, min_bytes=min_bytes)
    captures = assemble(written(read_records(pages.sparkSession, base, manifest), "warc-records"))
    kind = pages.schema["page_id"].dataType
    return captures.select(field("metadata", "key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                           field("metadata", "refers-to-key").cast(kind).alias("refers_to"), "intact", F.size("requests").cast("long").alias("n_requests"))
