import gzip
import os
import random

import pytest

from ingot.operators.selection import sample_head
from ingot.plans.load import infer_schema
from ingot.sources import heads
from ingot.sources.ndjson import read_lines
from tests.conftest import jl, write_gz


def files(tmp_path):
    rnd = random.Random(1)
    write_gz(str(tmp_path / "w" / "a" / "big.gz"), [f"{i} " + "".join(rnd.choices("abcdefghij0123456789", k=400)) for i in range(30_000)])
    write_gz(str(tmp_path / "w" / "b" / "small.gz"), ["x", "", "z"], newline_at_end=False)
    write_gz(str(tmp_path / "w" / "b" / "left.gz.tmp"), ["no"])
    with gzip.open(tmp_path / "w" / "b" / "ends.gz", "wb") as f:
        f.write("one\r\ntwo\rthree still\nfour".encode())
    with gzip.open(tmp_path / "w" / "empty.gz", "wb"):
        pass
    with open(tmp_path / "w" / "members.gz", "wb") as f:
        f.write(gzip.compress(b"m1\nm2\n") + gzip.compress(b"m3\nm4\n"))
    return str(tmp_path / "w")


def test_same_lines_as_the_text_scan(spark, tmp_path):
    root = files(tmp_path)
    for n in (1, 3, 2000):
        got = {(os.path.basename(r.file), r.line, r.value) for r in heads.head_lines(spark, root, n).collect()}
        scan = sample_head(read_lines(spark, [f"{root}/*.gz", f"{root}/*/*.gz"]), n, rank_col="line")
        assert got == {(os.path.basename(r.file), r.line, r.value) for r in scan.collect()} and len(got) >= 4


def test_bytes_read_stay_bounded(spark, tmp_path):
    root = files(tmp_path)
    size = os.path.getsize(f"{root}/a/big.gz")
    read = {n: heads.head_lines(spark, root, n).where("file like '%big.gz'").agg({"bytes_read": "max"}).first()[0] for n in (1, 100, 1000)}
    assert read[1] <= read[100] <= read[1000] < size / 10 and read[100] <= 100 * 400 + (1 << 18)


def test_partitions_limits_and_missing(spark, tmp_path, monkeypatch):
    root = files(tmp_path)
    assert heads.head_lines(spark, root, 2).rdd.getNumPartitions() == 5
    assert heads.head_lines(spark, root, 2, tasks=2).rdd.getNumPartitions() == 2
    assert {os.path.basename(r.file) for r in heads.head_lines(spark, root, 2, max_files=2).collect()} == {"big.gz", "ends.gz"}
    assert heads.head_lines(spark, f"{root}/none", 2).collect() == []
    one = {(os.path.basename(r.file), r.line, r.value) for r in heads.head_lines(spark, root, 5).collect()}
    monkeypatch.setattr(heads, "SCHEMES", ())  # a store that only Spark opens: the text scan
    assert one == {(os.path.basename(r.file), r.line, r.value) for r in heads.head_lines(spark, root, 5).collect()}


def test_broken_file_is_named(spark, tmp_path):
    root = files(tmp_path)
    data = open(f"{root}/a/big.gz", "rb").read()
    (tmp_path / "w" / "cut.gz").write_bytes(data[:200_000])
    assert heads.head_lines(spark, root, 10).where("file like '%cut.gz'").count() == 10  # the break is not reached
    with pytest.raises(Exception, match="cut.gz"):
        heads.head_lines(spark, root, 29_000).collect()


def test_schema_step_reads_heads(spark, tmp_path):
    write_gz(str(tmp_path / "data" / "works" / "f" / "p.gz"), jl({"a": 1}, {"a": 2}, {"a": "late"}))
    assert infer_schema(spark, "works", str(tmp_path / "data"), sample=2).simpleString() == "struct<a:bigint>"
    assert infer_schema(spark, "works", str(tmp_path / "data"), sample=3).simpleString() == "struct<a:string>"
