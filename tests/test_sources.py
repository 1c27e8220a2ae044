import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import jl, write_gz
from ingot.operators.selection import parse_batch_range, sample_head, select_batch
from ingot.sources.listing import choose_source, count_folders, list_files
from ingot.sources.manifest import read_manifest
from ingot.sources.ndjson import line_kind, parse_records, read_lines, read_records

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def test_good_line_predicate(spark):
    vals = ['{"a":1}', "{}", '{"a":1,"a":2}', '{"a":1}{', "", "   ", "not json", '{"a":', "null", "[1]"]
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    kinds = [r["k"] for r in df.select(line_kind(F.col("value")).alias("k")).collect()]
    assert kinds == ["good", "good", "good", "good", "blank", "blank", "bad", "bad", "bad", "bad"]


def test_tolerant_scan_drops_and_counts(spark, tmp_path):
    p = str(tmp_path / "d" / "f1" / "a.gz")
    write_gz(p, ['{"id":"x","n":1}', "", "garbage", '{"id":"y","n":"2"}', '{"id":"z"}'], newline_at_end=False)
    from pyspark.sql import Observation
    obs = Observation("scan")
    df = read_records(spark, str(tmp_path / "d"), SCHEMA, "tolerant", root=str(tmp_path / "d"), observation=obs)
    rows = sorted((r["id"], r["n"], r["folder"]) for r in df.collect())
    # a quoted number parses as a record (the field is NULL under Spark's reader)
    assert rows == [("x", 1, "f1"), ("y", None, "f1"), ("z", None, "f1")]
    assert obs.get == {"lines": 5, "records": 3, "dropped_bad": 1, "blank": 1}


def test_strict_scan_fails_on_bad_line(spark, tmp_path):
    p = str(tmp_path / "s" / "a.gz")
    write_gz(p, ['{"id":"x"}', "{broken"])
    with pytest.raises(Exception, match="bad NDJSON line"):
        read_records(spark, p, SCHEMA, "strict").collect()


def test_listing_excludes_manifest_and_tmp(spark, snapshot):
    files = list_files(spark, str(snapshot / "works"))
    names = sorted(r["rel_path"] for r in files.collect())
    assert len(names) == 6 and all(n.endswith(".gz") for n in names)
    assert count_folders(files).first()["n_folders"] == 3


def test_batch_range_is_alphabetical(spark, snapshot):
    files = list_files(spark, str(snapshot / "works"))
    sel = select_batch(files, *parse_batch_range("2-3"))
    assert sorted({r["folder"] for r in sel.collect()}) == ["updated_date=2024-01-02", "updated_date=2024-01-03"]
    with pytest.raises(ValueError):
        parse_batch_range("2..3")


def test_sample_head_per_file_in_line_order(spark, tmp_path):
    for f in ("a", "b"):
        write_gz(str(tmp_path / "h" / f"{f}.gz"), jl(*[{"id": f"{f}{i}", "n": i} for i in range(50)]))
    lines = read_lines(spark, str(tmp_path / "h"), root=str(tmp_path / "h"))
    head = parse_records(sample_head(lines, 7), SCHEMA, keep=("rel_path",))
    got = sorted((r["rel_path"], r["n"]) for r in head.collect())
    assert got == sorted((f"{f}.gz", i) for f in "ab" for i in range(7))


def test_manifest_scan(spark, tmp_path):
    doc = {"meta": {"record_count": 10}, "entries": [
        {"url": "s3://bucket/data/works/updated_date=2024-01-01/part_000.gz", "meta": {"record_count": 4}},
        {"url": "s3://bucket/data/works/updated_date=2024-01-02/part_000.gz", "meta": {"record_count": 5}}]}
    os.makedirs(tmp_path / "works")
    (tmp_path / "works" / "manifest").write_text(json.dumps(doc, indent=2))
    rows = read_manifest(spark, str(tmp_path / "works" / "manifest"), "s3://bucket/data/").collect()
    assert sorted((r["dataset"], r["rel_path"], r["expected"], r["total"]) for r in rows) == [
        ("works", "works/updated_date=2024-01-01/part_000.gz", 4, 10),
        ("works", "works/updated_date=2024-01-02/part_000.gz", 5, 10)]


def test_choose_source(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    assert choose_source(spark, str(tmp_path / "conv"), str(tmp_path / "raw")).endswith("raw")
    (tmp_path / "conv").mkdir()
    assert choose_source(spark, str(tmp_path / "conv"), str(tmp_path / "raw")).endswith("conv")
    assert choose_source(spark, str(tmp_path / "x"), str(tmp_path / "y")) is None


def test_first_n_plans_partial_limit_before_shuffle(spark):
    from ingot.operators.selection import first_n

    df = spark.range(10000).selectExpr("id % 3 AS g", "id")
    out = first_n(df, 1500, ["g"], [F.col("id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert out.count() == 4500


def test_tsv_ledger_and_latest_status(spark, tmp_path):
    from ingot.sources.ledger import append_ledger, latest_status, read_ledger, read_ledger_tsv

    p = tmp_path / "works.tsv"
    p.write_text("file\tactual\texpected\tstatus\nworks/a.gz\t3\t3\tOK\nworks/b.gz\t1\t2\tMISMATCH\n")
    rows = {r["file"]: r["status"] for r in read_ledger_tsv(spark, str(p), "validation").collect()}
    assert rows == {"works/a.gz": "OK", "works/b.gz": "MISMATCH"}
    root = str(tmp_path / "ledger")
    append_ledger(read_ledger_tsv(spark, str(p), "validation"), root, "validation", "v1", "works", batch=0)
    fix = spark.createDataFrame([("works/b.gz", 2, 2, "OK")], "file string, actual bigint, expected bigint, status string")
    append_ledger(fix, root, "validation", "v1", "works", batch=1)
    cur = {r["file"]: r["status"] for r in latest_status(read_ledger(spark, root, "validation", "v1", "works")).collect()}
    assert cur == {"works/a.gz": "OK", "works/b.gz": "OK"}


def test_ndjson_dynamic_overwrite_keeps_other_folders(spark, tmp_path):
    from ingot.sinks.ndjson import write_ndjson

    out = str(tmp_path / "o")
    df = spark.createDataFrame([("a", 1, None), ("b", 2, None)], "folder string, n bigint, x string")
    write_ndjson(df, out, partition_by="folder")
    write_ndjson(spark.createDataFrame([("a", 9, None)], "folder string, n bigint, x string"), out,
                 partition_by="folder", mode="overwrite")
    back = {(r["folder"], r["n"]) for r in spark.read.json(out).collect()}
    assert back == {("a", 9), ("b", 2)}
    # nulls are written explicitly by default
    assert '"x":null' in spark.read.text(out).first()["value"]


def test_odd_file_names_map_between_listing_and_scan(spark, tmp_path):
    """Listings report plain paths, _metadata.file_path is percent-encoded; both must
    give the same relative path for names with '+', spaces, '%' and '='."""
    root = tmp_path / "odd"
    names = ["a+b.gz", "c d.gz", "e%20f.gz", "k=v/g.gz"]
    for n in names:
        write_gz(str(root / "works" / n), jl({"id": n}))
    listed = sorted(r["rel_path"] for r in list_files(spark, str(root / "works")).collect())
    scanned = sorted(r["rel_path"] for r in read_lines(spark, str(root / "works"), root=str(root / "works"))
                     .select("rel_path").distinct().collect())
    assert listed == scanned == sorted(names)
