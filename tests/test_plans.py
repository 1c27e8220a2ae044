import json
import os

from pyspark.sql import functions as F

from conftest import jl, write_gz
from ingot.catalog import table_schema
from ingot.operators.profile import resolve_schema
from ingot.plans.convert import convert, convert_all
from ingot.plans.load import infer_schema, load_dataset
from ingot.plans.publish import publish_files
from ingot.sinks.schema_file import write_schema_file
from ingot.sources.schema_files import read_schema_file, schema_catalog


def _works_snapshot(root):
    recs = [{"id": "W1", "apc_list": {"value": 5}, "locations": None},
            {"id": "W2", "authorships": [{"institutions": []}], "abstract_inverted_index": {"a": [0]}}]
    write_gz(os.path.join(root, "works", "updated_date=2024-01-01", "p0.gz"), jl(*recs) + ["bad line"])
    write_gz(os.path.join(root, "works", "updated_date=2024-01-02", "p0.gz"), jl({"id": "W3"}))


def test_convert_batches_and_skips_done_files(spark, tmp_path):
    raw, out, led = str(tmp_path / "raw"), str(tmp_path / "conv"), str(tmp_path / "led")
    _works_snapshot(raw)
    c1 = convert(spark, "works", "v1", raw, out, led, batch="1-1")
    assert (c1["records"], c1["dropped"]) == (2, 1)
    c2 = convert(spark, "works", "v1", raw, out, led, batch_id=1)
    assert c2["skipped"] == 1 and c2["records"] == 1
    c3 = convert(spark, "works", "v1", raw, out, led, batch_id=2)
    assert c3["records"] == 0 and c3["skipped"] == 2
    # a crash after the write but before the ledger append: the rerun replaces, not duplicates
    led2 = str(tmp_path / "led2")
    convert(spark, "works", "v1", raw, out, led2, batch="2-2")
    assert spark.read.text(os.path.join(out, "works")).count() == 3
    back = spark.read.schema(table_schema("works")).json(os.path.join(out, "works"))
    rows = {r["id"]: r for r in back.collect()}
    assert set(rows) == {"W1", "W2", "W3"}
    assert rows["W1"]["apc_list"][0]["value"] == 5 and rows["W3"]["apc_list"][0]["value"] is None
    assert rows["W1"]["locations"][0]["is_oa"] is False
    assert rows["W2"]["abstract_inverted_index"] == '{"a":[0]}'


def test_schema_infer_write_resolve_and_load(spark, tmp_path):
    data = str(tmp_path / "data")
    write_gz(os.path.join(data, "funders", "f1", "a.gz"), jl({"id": "F1", "n": "3", "tags": ["x"]}, {"id": "F2", "n": 4}))
    from pyspark.sql import Observation
    obs = Observation("sampled")
    st = infer_schema(spark, "funders", data, sample=1000, observation=obs)
    assert st.simpleString() == "struct<id:string,n:bigint,tags:array<string>>"
    assert obs.get["sampled_lines"] == 2
    sroot = str(tmp_path / "schemas")
    os.makedirs(os.path.join(sroot, "20260203"))
    os.makedirs(os.path.join(sroot, "20241125"))
    write_schema_file(spark, st, os.path.join(sroot, "20241125", "funders_schema.json"))
    write_schema_file(spark, st, os.path.join(sroot, "20241125", "funders.schema.json"))
    resolved = resolve_schema(schema_catalog(spark, sroot), "20260203").collect()
    assert [r["path"].rsplit("/", 1)[-1] for r in resolved] == ["funders.schema.json"]
    schema = read_schema_file(spark, resolved[0]["path"])
    res = load_dataset(spark, "funders", "t9", data, schema, str(tmp_path / "tables"), max_bad=0)
    assert res["rows"] == 2 and res["bad"] == 0
    assert sorted(r["n"] for r in spark.table("funders_t9").collect()) == [3, 4]


def test_publish_files_ledger(spark, tmp_path):
    src, dest, led = str(tmp_path / "src"), str(tmp_path / "dest"), str(tmp_path / "led")
    for i in range(3):
        write_gz(os.path.join(src, "topics", "f", f"p{i}.gz"), jl({"i": i}))
    t1 = publish_files(spark, "topics", "v1", src, dest, led, max_files=2).first()
    assert (t1["uploaded_ok"], t1["skipped"]) == (2, 0)
    t2 = publish_files(spark, "topics", "v1", src, dest, led, batch_id=1).first()
    assert (t2["uploaded_ok"], t2["skipped"]) == (1, 2)
    assert spark.read.text(os.path.join(dest, "v1", "topics")).count() == 3


def test_convert_all_passes_through_unconvertible(spark, tmp_path):
    from ingot.plans.convert import convert_all

    raw = str(tmp_path / "raw")
    write_gz(os.path.join(raw, "topics", "f", "a.gz"), jl({"id": "T1"}))
    _works_snapshot(raw)
    res = convert_all(spark, ["topics", "works"], "v1", raw, str(tmp_path / "conv"), str(tmp_path / "led"))
    assert res["topics"]["converted"] is False
    assert res["works"]["records"] == 3
    assert not os.path.exists(tmp_path / "conv" / "topics")


def test_load_all_resolves_and_skips(spark, tmp_path):
    from ingot.plans.load import load_all

    raw, conv, sroot = str(tmp_path / "raw"), str(tmp_path / "conv"), str(tmp_path / "schemas")
    write_gz(os.path.join(raw, "domains", "f", "a.gz"), jl({"id": "D1", "tags": ["x"]}, {"id": "D2"}))
    write_gz(os.path.join(raw, "fields", "f", "a.gz"), jl({"id": "F1"}))
    os.makedirs(os.path.join(sroot, "20241125"))
    from pyspark.sql import types as T
    st = T.StructType([T.StructField("id", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType()))])
    write_schema_file(spark, st, os.path.join(sroot, "20241125", "domains.schema.json"))
    res, skipped = load_all(spark, ["domains", "fields", "works"], "20260203", conv, raw, sroot,
                            str(tmp_path / "tables"))
    assert skipped == ["fields", "works"] and res["domains"]["rows"] == 2
    rows = {r["id"]: r["tags"] for r in spark.table("domains_20260203").collect()}
    assert rows == {"D1": ["x"], "D2": []}  # absent REPEATED field loads as []


def test_converted_files_validate_against_the_manifest(spark, tmp_path):
    import json

    from ingot.plans.validate import validate_all

    raw, conv, led = str(tmp_path / "raw"), str(tmp_path / "conv"), str(tmp_path / "led")
    _works_snapshot(raw)  # folder 01: 2 records + 1 bad line; folder 02: 1 record
    prefix = "s3://bucket/data/"
    man = {"meta": {"record_count": 3}, "entries": [
        {"url": prefix + "works/updated_date=2024-01-01/p0.gz", "meta": {"record_count": 2}},
        {"url": prefix + "works/updated_date=2024-01-02/p0.gz", "meta": {"record_count": 1}}]}
    with open(os.path.join(raw, "works", "manifest"), "w") as f:
        json.dump(man, f)
    convert_all(spark, ["works"], "v1", raw, conv, led)
    summary, ok, skipped = validate_all(spark, ["works"], "v1", conv, raw, str(tmp_path / "vled"), prefix)
    row = summary.first()
    assert ok and (row["actual"], row["n_ok"], row["verdict"]) == (3, 2, "PASS")
    # rerunning the conversion of the same files replaces, never duplicates
    convert(spark, "works", "v1", raw, conv, str(tmp_path / "led_again"))
    assert spark.read.text(os.path.join(conv, "works")).count() == 3


def test_infer_all_prefers_converted_and_merges(spark, tmp_path):
    from ingot.plans.load import infer_all

    raw, conv, sroot = str(tmp_path / "raw"), str(tmp_path / "conv"), str(tmp_path / "schemas")
    write_gz(os.path.join(raw, "topics", "f", "a.gz"), jl({"id": "T1", "n": 1}))
    write_gz(os.path.join(conv, "topics", "f", "a.gz"), jl({"id": "T1", "n": 1.5}))
    got, skipped = infer_all(spark, ["topics", "fields"], "v1", conv, raw, sroot)
    assert skipped == ["fields"] and got["topics"].simpleString() == "struct<id:string,n:double>"
    # a later snapshot adds a field: the existing file is merged, never narrowed
    write_gz(os.path.join(conv, "topics", "f", "a.gz"), jl({"id": "T2", "extra": True}))
    got2, _ = infer_all(spark, ["topics"], "v1", conv, raw, sroot)
    assert got2["topics"].simpleString() == "struct<extra:boolean,id:string,n:double>"
    assert os.path.exists(os.path.join(sroot, "v1", "topics.schema.json"))


def test_publish_all_over_datasets(spark, tmp_path):
    from ingot.plans.publish import publish_all

    raw, conv = str(tmp_path / "raw"), str(tmp_path / "conv")
    write_gz(os.path.join(raw, "topics", "f", "a.gz"), jl({"i": 1}))
    write_gz(os.path.join(conv, "works", "f", "a.gz"), jl({"i": 2}))
    t, skipped = publish_all(spark, ["topics", "works", "fields"], "v1", conv, raw, str(tmp_path / "dest"),
                             str(tmp_path / "led"), max_files=5)
    assert skipped == ["fields"]
    assert {r["dataset"]: r["uploaded_ok"] for r in t.collect()} == {"topics": 1, "works": 1}
