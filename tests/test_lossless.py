"""Conversion keeps what no rule touches; broken files fail alone; discovery; strictness at depth."""

import gzip
import json
import os

import pytest
from pyspark.sql import types as T

from conftest import jl, write_gz
from ingot import schemas
from ingot.operators.profile import facts_of_lines
from ingot.operators.shape import merge_shapes, parse_shape
from ingot.operators.strict import strict_parse, unknown_paths
from ingot.plans.convert import batch_schema, convert
from ingot.plans.load import infer_all, infer_schema, load_dataset
from ingot.plans.publish import publish_files
from ingot.plans.validate import validate_dataset
from ingot.session import fs_rename, fs_write_text, fs_read_text, shared_root
from ingot.sinks.table import BadRecordLimitExceeded, publish_table
from ingot.sources.ledger import append_ledger, latest_status, read_ledger


def converted(spark, tmp_path, dataset, *records, **options):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "conv")
    write_gz(os.path.join(raw, dataset, "f=1", "p0.gz"), jl(*records))
    c = convert(spark, dataset, "v1", raw, out, str(tmp_path / "led"), **options)
    got = {}
    for r in spark.read.option("recursiveFileLookup", "true").text(f"{out}/{dataset}").collect():
        rec = json.loads(r.value)
        got[rec["id"]] = rec
    return c, got


FULL_WORK = {"id": "W0", "apc_list": [{"value": 1, "x": None}], "locations": [{"is_oa": True, "odd": {"k": [1, None, "a"]}}], "best_oa_location": {"is_oa": False, "oa_status": "gold"},
             "primary_location": {"source": {"id": "S", "issn": ["1"], "n": "7"}}, "authorships": [], "corresponding_author_ids": [], "corresponding_institution_ids": ["I"],
             "indexed_in": [], "referenced_works": ["W9"], "related_works": [], "cited_by_count": "7", "brand_new": {"x": 1, "y.z": [1.5, None]}, "ids": {"mag": "123", "newid": "z"},
             "updated_date": "2024-01-05T10:11:12.123456", "nothing": None, "mixed": "a", "big": 12345678901234567890123, "tiny": 1e-7, "flag": True}


def test_works_without_anything_to_repair_come_back_equal(spark, tmp_path):
    other = {"id": "W1", "mixed": {"deep-key": [1]}, "cited_by_count": 7, "locations": [{"odd": "text"}]}
    c, got = converted(spark, tmp_path, "works", FULL_WORK, other)
    assert c["records"] == 2 and got["W0"] == FULL_WORK | {"apc_list": [{"value": 1, "x": None}]}
    assert got["W1"]["mixed"] == {"deep-key": [1]} and got["W1"]["cited_by_count"] == 7 and got["W1"]["locations"] == [{"odd": "text"}]
    assert got["W1"]["referenced_works"] == [] and got["W1"]["primary_location"]["is_oa"] is False


def test_a_rule_column_of_several_kinds_keeps_its_values(spark, tmp_path):
    _, got = converted(spark, tmp_path, "works", {"id": "a", "referenced_works": "W9", "locations": {"is_oa": True}},
                       {"id": "b", "referenced_works": ["W1"], "locations": [{"is_oa": "yes"}]}, {"id": "c"})
    assert got["a"]["referenced_works"] == "W9" and got["a"]["locations"] == {"is_oa": True}
    assert got["b"]["locations"] == [{"is_oa": "yes"}] and got["c"]["referenced_works"] == [] and got["c"]["locations"][0]["is_oa"] is False


def test_hyphens_at_any_spelling_and_depth(spark, tmp_path):
    rec = {"id": "I1", "display-name_acronyms": ["x"], "new-key": 1, "geo": {"extra-mix_ed-key": "v-1", "extra": 2}, "a-b": None, "a_b": 5,
           "counts_by_year": [{"year": 2020, "works-count": "3"}], "mixed": [{"k-k": "x-y: \"q\""}, "s-t"], "international": {"display_name": {"zh-cn": "n"}}}
    _, got = converted(spark, tmp_path, "institutions", rec, {"id": "I2", "mixed": 3, "same": [{"international": {"a-a": 1}}]})
    assert got["I1"] == {"id": "I1", "display_name_acronyms": ["x"], "new_key": 1, "geo": {"extra_mix_ed_key": "v-1", "extra": 2}, "a_b": None,
                         "counts_by_year": [{"year": 2020, "works_count": "3"}], "mixed": [{"k_k": "x-y: \"q\""}, "s-t"]}
    assert got["I2"] == {"id": "I2", "mixed": 3, "same": [{"international": {"a_a": 1}}]}


def test_sources_lose_only_null_elements(spark, tmp_path):
    _, got = converted(spark, tmp_path, "sources", {"id": "S1", "issn": None, "topics": [None, {"x": [1, None]}], "n": "5", "odd": [1, "a", None]}, {"id": "S2"})
    assert got == {"S1": {"id": "S1", "issn": [], "topics": [{"x": [1]}], "n": "5", "odd": [1, "a"]}, "S2": {"id": "S2"}}


def test_keys_that_differ_in_case_are_refused():
    with pytest.raises(ValueError, match="case"):
        batch_schema("sources", ["OBJECT<a: STRING>", "OBJECT<A: STRING>"])


def test_shapes_merge():
    a, b = parse_shape("OBJECT<a: BIGINT, `b.c`: ARRAY<OBJECT<x: STRING>>>"), parse_shape("OBJECT<a: DECIMAL(2,1), `b.c`: ARRAY<VOID>, d: OBJECT<>>")
    m = merge_shapes(a, b)
    assert m == merge_shapes(m, a) and [f.name for f in m.fields] == ["a", "b.c", "d"] and m["b.c"].dataType == a["b.c"].dataType
    assert merge_shapes(parse_shape("STRING"), parse_shape("ARRAY<STRING>")) == T.VariantType()


def test_broken_files_fail_alone_and_are_tried_again(spark, tmp_path):
    raw, out, led = (str(tmp_path / x) for x in ("raw", "conv", "led"))
    for i in range(4):
        write_gz(os.path.join(raw, "sources", "f", f"p{i}.gz"), jl({"id": f"S{i}"}))
    write_gz(os.path.join(raw, "sources", "f", "bad.gz"), jl({"id": "X"}) + ["{"])
    whole = gzip.compress(("\n".join(jl({"id": "Y"})) * 500).encode())
    with open(os.path.join(raw, "sources", "f", "cut.gz"), "wb") as f:
        f.write(whole[:len(whole) // 2])
    c = convert(spark, "sources", "v1", raw, out, led, group_files=4)
    assert (c["files"], c["failed"], c["records"]) == (6, 2, 4) and set(c["errors"]) == {"f/bad.gz", "f/cut.gz"}
    rows = {r.file: (r.records, r.status) for r in latest_status(read_ledger(spark, led, "convert", "v1", "sources")).collect()}
    assert rows["f/p1.gz"] == (1, "OK") and rows["f/bad.gz"] == (None, "FAIL")
    write_gz(os.path.join(raw, "sources", "f", "bad.gz"), jl({"id": "X"}))
    c = convert(spark, "sources", "v1", raw, out, led, batch_id=1)
    assert (c["skipped"], c["failed"], c["records"]) == (4, 1, 1)
    # works skips the bad line instead
    write_gz(os.path.join(raw, "works", "f", "p.gz"), jl({"id": "W"}) + ["{"])
    assert convert(spark, "works", "v1", raw, out, led)["dropped"] == 1


def test_inference_on_converted_data_finds_a_new_field(spark, tmp_path):
    converted(spark, tmp_path, "sources", {"id": "S1", "is_new": {"x": 1}})
    out, _ = infer_all(spark, ["sources"], "v1", str(tmp_path / "conv"), str(tmp_path / "raw"), str(tmp_path / "schemas"))
    assert "is_new" in out["sources"].names


def test_discovery_at_any_depth(spark, tmp_path):
    data = str(tmp_path / "data")
    write_gz(os.path.join(data, "topics", "root.gz"), jl({"id": "a", "r": 1}))
    write_gz(os.path.join(data, "topics", "x", "y", "z", "deep.gz"), jl({"id": "b", "d": 1}))
    write_gz(os.path.join(data, "topics", "x", "half.gz.tmp"), jl({"id": "c", "t": 1}))
    with open(os.path.join(data, "topics", "manifest"), "w") as f:
        f.write('{"m": 1}')
    st = infer_schema(spark, "topics", data)
    assert sorted(st.names) == ["d", "id", "r"]
    assert sorted(infer_schema(spark, "topics", data, max_files=1).names) == ["id", "r"]
    assert load_dataset(spark, "topics", "t_depth", data, st, str(tmp_path / "tables"))["rows"] == 2
    conv = convert(spark, "sources", "v1", data, str(tmp_path / "c"), str(tmp_path / "l")) if os.path.isdir(os.path.join(data, "sources")) else None
    assert conv is None


def test_validation_follows_the_files(spark, tmp_path):
    raw, conv, led = (str(tmp_path / x) for x in ("raw", "conv", "led"))
    for n, recs in (("a", [{"id": "1"}]), ("b", [{"id": "2"}, {"id": "3"}]), ("empty", [])):
        write_gz(os.path.join(raw, "sources", "f", f"{n}.gz"), jl(*recs), newline_at_end=bool(recs))
    write_gz(os.path.join(raw, "sources", "root.gz"), jl({"id": "4"}))
    entries = [("f/a.gz", 1), ("f/b.gz", 2), ("f/empty.gz", 0), ("root.gz", 1)]
    manifest = str(tmp_path / "sources" / "manifest")
    fs_write_text(spark, manifest, json.dumps({"meta": {"record_count": 4}, "entries": [{"url": f"u/sources/{p}", "meta": {"record_count": n}} for p, n in entries]}))
    status = lambda root, **o: ({r.rel_path.removeprefix("sources/"): r.status for r in validate_dataset(spark, "sources", "v1", root, manifest, led, "u/", **o)[0].collect()})
    ok = {p: "OK" for p, _ in entries}
    assert status(raw) == ok
    os.remove(os.path.join(raw, "sources", "f", "b.gz"))
    assert status(raw) == ok | {"f/b.gz": "FILE NOT FOUND"}
    write_gz(os.path.join(raw, "sources", "f", "b.gz"), jl({"id": "2"}, {"id": "3"}))
    led = str(tmp_path / "led2")
    convert(spark, "sources", "v1", raw, conv, led)
    assert status(conv) == ok
    empty = str(tmp_path / "none" / "sources" / "manifest")
    fs_write_text(spark, empty, '{"meta": {"record_count": 0}, "entries": []}')
    per_file, summary = validate_dataset(spark, "sources", "v1", raw, empty, str(tmp_path / "led3"), "u/")
    assert per_file.count() == 0 and [r.verdict for r in summary.collect()] == ["PASS"]


def test_latest_status_without_batch_ids(spark, tmp_path):
    for status in ("MISMATCH", "OK", "MISMATCH", "OK"):
        append_ledger(spark.createDataFrame([("f", 1, 1, status)], "file string, actual bigint, expected bigint, status string"), str(tmp_path), "validation", "v", "d")
    assert [r.status for r in latest_status(read_ledger(spark, str(tmp_path), "validation", "v", "d")).collect()] == ["OK"]


def test_publish_keeps_file_names_and_fails_alone(spark, tmp_path):
    src, dest, led = (str(tmp_path / x) for x in ("src", "dest", "led"))
    write_gz(os.path.join(src, "topics", "f=1", "a b.gz"), jl({"i": 1}, {"i": 2}))
    write_gz(os.path.join(src, "topics", "root.gz"), jl({"i": 3}))
    os.makedirs(os.path.join(src, "topics", "g"))
    with open(os.path.join(src, "topics", "g", "noise.gz"), "w") as f:
        f.write("no gzip")
    t = publish_files(spark, "topics", "v1", src, dest, led).first()
    assert (t.uploaded_ok, t.upload_failed, t.skipped) == (2, 1, 0)
    rows = {r.file: r for r in read_ledger(spark, led, "upload", "v1", "topics").collect()}
    assert rows["g/noise.gz"].status == "FAIL" and rows["g/noise.gz"].destination is None
    assert os.path.isdir(rows["f=1/a b.gz"].destination) and os.path.isdir(rows["root.gz"].destination)
    assert publish_files(spark, "topics", "v1", src, dest, led, batch_id=1).first().skipped == 2


def test_strictness_at_every_depth(spark):
    schema = T.DataType.fromDDL("struct<id: bigint, a: array<struct<b: struct<c: array<string>, t: string>>>, m: string>")
    lines = ['{"id":1,"a":[{"b":{"c":["x"]}}]}', '{"id":2,"a":[{"b":{"z":1}}]}', '{"id":3,"a":[{"b":{"c":null}}]}', '{"id":4,"a":[null]}', '{"id":5,"a":[{"b":{"c":[null]}}]}',
             '{"id":6,"a":[{}],"m":{"any":{"thing":null}}}', '{"id":7}', '{"id":8,"a":[{"b":null}]}', '{"id":9,"a":[{"q":{}}]}']
    got = {r.id: r._bad_reason for r in strict_parse(spark.createDataFrame([(x,) for x in lines], "value string"), schema, keep=()).collect()}
    assert got == {1: None, 2: "unknown field: a.b.z", 3: "null for repeated field: a.b.c", 4: "null element: a", 5: "null element: a.b.c", 6: None, 7: None, 8: None, 9: "unknown field: a.q"}
    words = json.dumps({"id": 1, "m": {f"w{i}": [i] for i in range(300)}, "x": {"y": 1}})
    assert {r.path for r in unknown_paths(spark.createDataFrame([(words,)], "value string"), schema).collect()} == {"x", "x.y"}


def test_dots_in_keys_stay_in_their_key():
    facts = facts_of_lines(['{"a.b": {"c\\\\d": 1}, "a": {"b": 2}}'])
    paths = {p for p, _, _ in facts}
    assert paths == {"a\\.b", "a\\.b.c\\\\d", "a", "a.b"}
    st = schemas.struct_from_paths([("a\\.b", "RECORD", "NULLABLE"), ("a\\.b.c\\\\d", "INTEGER", "NULLABLE"), ("a", "RECORD", "NULLABLE"), ("a.b", "INTEGER", "NULLABLE")])
    assert {f.name for f in st.fields} == {"a", "a.b"} and st["a.b"].dataType.names == ["c\\d"] and len(schemas.flatten(st)) == 4


def test_tables_and_files_are_swapped_in_one_step(spark, tmp_path):
    df = spark.range(5).toDF("k")
    loc = str(tmp_path / "t")
    a = publish_table(spark, df, "orders", "swap1", loc)
    b = publish_table(spark, df.where("k < 2"), "orders", "swap1", loc)
    assert spark.table(b["table"]).count() == 2 and not os.path.isdir(a["path"])
    with pytest.raises(BadRecordLimitExceeded):
        publish_table(spark, df, "orders", "swap1", loc, bad=df["k"] > 3)
    assert os.listdir(os.path.join(loc, b["table"])) == [os.path.basename(b["path"])] and spark.table(b["table"]).count() == 2
    p = str(tmp_path / "x.json")
    for text in ("one", "two"):
        fs_write_text(spark, p + ".tmp", text)
        fs_rename(spark, p + ".tmp", p)
    assert fs_read_text(spark, p) == "two" and os.listdir(tmp_path / "t")


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())
