"""WARC archives: round trip, revisits, transaction assembly."""

import gzip
import hashlib
from collections import Counter, defaultdict

import pytest

from ingot.llm import warc
from tests.llm.test_operators import same


def brute(rows):
    groups = defaultdict(list)
    for page, url, html in rows:
        data = (html or "").encode()
        groups[data].append((page, url))
    for data, members in groups.items():
        digest = hashlib.sha256(data).hexdigest()
        pages = sorted((m[0] for m in members), key=lambda p: (p is None, p or 0))
        for k, page in enumerate(pages):
            again = len(data) >= 100 and k > 0
            yield page, len(data), digest, "revisit" if again else "response", pages[0] if again else None, True, 1


def odd_rows():
    rows = [(i, f"http://a.example.com/{i}", f"<p>{i}</p>" * 30) for i in range(50)]
    rows += [(100 + i, f"https://b.example.org/x y?{i}", "<html>same é</html>\r\n\r\nWARC/1.1\r\n" * 9) for i in range(80)]  # a hot payload
    rows += [(300 + i, "u", "short") for i in range(9)] + [(400 + i, None, "a" * 99) for i in range(2)] + [(410 + i, "", "a" * 100) for i in range(2)]
    rows += [(500, "http://x/", None), (501, "http://x/", ""), (None, "http://n/", "<n>" * 50), (None, None, "<n>" * 50), (None, None, None), (502, "a\r\nb: c", "<big>" * 400_000),
             (503, "http://r/", "<r>" * 50), (503, "http://r/", "<r>" * 50), (503, "http://r/", "<r>" * 50), (503, "http://s/", "<r>" * 50), (503, "http://r/", "<other>" * 50)]
    return rows


def test_round_trip(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, payload string, n long").repartition(3)
    same(warc.archived(df).collect(), brute(rows))
    assert warc.archived(df.where("false")).collect() == []
    named = warc.archived(df.selectExpr("concat('p ', page_id, '\n') page_id", "url", "html"))
    assert {r.page_id for r in named.collect()} == {None if r[0] is None else f"p {r[0]}\n" for r in rows}


def test_archives_and_nested_rows(spark, tmp_path):
    rows = [r for r in odd_rows() if r[0] is not None]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    base, manifest = warc.write_archive(df, str(tmp_path / "a"), file_bytes=3000)
    names = [r.name for r in manifest.collect()]
    assert len(names) > 3 and sum(r.n_records for r in manifest.collect()) == 3 * len(rows) + len(names)
    for name in names:  # one gzip member per record, plain WARC inside
        raw = (tmp_path / "a" / name).read_bytes()
        assert gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    records = warc.read_records(spark, base, manifest, payload=True).cache()
    assert Counter(r.type for r in records.collect()) == {"request": len(rows), "metadata": len(rows), "warcinfo": len(names),
                                                         "response": sum(x[3] == "response" for x in brute(rows)), "revisit": sum(x[3] == "revisit" for x in brute(rows))}
    assert records.select("record_id").distinct().count() == records.count()
    nested = warc.assemble(records).collect()
    assert len(nested) == len(rows)
    assert Counter(bytes(r.payload) for r in nested if r.type == "response") == Counter({h.encode(): 1 for _, _, h in rows if len((h or "").encode()) >= 100} | Counter((h or "").encode() for _, _, h in rows if len((h or "").encode()) < 100))
    ids = {r.record_id: r for r in nested}
    for r in nested:
        assert [x.concurrent_to for x in r.requests] == [x.concurrent_to for x in r.metadata] == [[r.record_id]]
        if r.type == "revisit":
            assert ids[r.refers_to].type == "response" and ids[r.refers_to].payload_digest == r.payload_digest and r.payload == b""


def record(type_, id_, block=b"", *more):
    lines = [f"WARC-Type: {type_}", f"WARC-Record-ID: {id_}", "WARC-Date: 2020-01-01T00:00:00Z", *more, f"Content-Length: {len(block)}"]
    return ("WARC/1.0\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def read(spark, base, **files):
    base.mkdir(exist_ok=True)
    for name, data in files.items():
        (base / name).write_bytes(data)
    return warc.read_records(spark, str(base), spark.createDataFrame([(n,) for n in files], "name string"))


def test_assembly_over_files_and_steps(spark, tmp_path):
    http = "Content-Type: application/http; msgtype=response"
    a = record("response", "<r1>", b"HTTP/1.1 404 Not\r\nX: 1\r\n\r\nbody", http, "WARC-Concurrent-To: <q1>", "WARC-Payload-Digest: sha256:" + "0" * 64)
    a += record("metadata", "<m1>", b"a: b%20c\r\n", "Content-Type: application/warc-fields", "WARC-Concurrent-To: <q1>")  # by way of the request
    a += record("resource", "<s1>", b"raw", "Content-Type: text/dns") + record("metadata", "<lost>", b"", "WARC-Concurrent-To: <nowhere>")
    b = record("request", "<q1>", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http; msgtype=request") + record("metadata", "<m2>", b"", "WARC-Concurrent-To: <m1>", "WARC-Concurrent-To: <s1>")
    b += record("conversion", "<c>", b"x") + record("response", "<r2>", b"HTTP/1.1 200 OK\r\n\r\n", http, "WARC-Concurrent-To: <q1>")
    got = {r.record_id: r for r in warc.assemble(read(spark, tmp_path / "t", one=gzip.compress(a), two=b).cache()).collect()}
    assert {k: ([x.record_id for x in r.requests], [x.record_id for x in r.metadata]) for k, r in got.items()} == {
        "<r1>": (["<q1>"], ["<m1>", "<m2>"]), "<r2>": (["<q1>"], ["<m1>", "<m2>"]), "<s1>": (["<q1>"], ["<m1>", "<m2>"])}
    one = got["<r1>"]
    assert (one.http_status, one.payload_bytes, one.intact, one.metadata[0].fields[0].value) == (404, 4, False, "b c")


@pytest.mark.parametrize("data", [b"junk\r\n", record("response", "<x>", b"12345")[:-6], b"WARC/1.1\r\nWARC-Type: response\r\n"])
def test_broken_archives(spark, tmp_path, data):
    with pytest.raises(Exception, match="broken"):
        read(spark, tmp_path / "b", broken=record("warcinfo", "<w>") + data).collect()
