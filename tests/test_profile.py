import json

from ingot import schemas
from ingot.catalog import DATASETS, table_schema
from ingot.operators import profile as P


def _profile(spark, *recs):
    lines = spark.createDataFrame([(json.dumps(r) if not isinstance(r, str) else r,) for r in recs], "value string")
    return {r["path"]: (r["type"], r["mode"]) for r in P.merge_facts(P.json_facts(lines)).collect()}


def test_lattice(spark):
    got = _profile(spark,
                   {"a": 1, "b": 1, "c": "12", "d": "2024-01-02", "e": "2024-01-02T10:00:00Z", "f": [], "g": None,
                    "h": {}, "i": {"x": 1}, "j": True, "k": "abc"},
                   {"a": 1.5, "b": "x", "c": 7, "i": [{"x": 2, "y": "s"}], "j": "false"},
                   "not json", "[1,2]")
    assert got["a"] == ("FLOAT", "NULLABLE")
    assert got["b"] == ("STRING", "NULLABLE")
    assert got["c"] == ("INTEGER", "NULLABLE")
    assert got["d"] == ("DATE", "NULLABLE")
    assert got["e"] == ("TIMESTAMP", "NULLABLE")
    assert got["f"] == ("STRING", "REPEATED")
    assert got["g"] == ("STRING", "NULLABLE")
    assert got["h"] == ("RECORD", "NULLABLE")
    assert got["i"] == ("RECORD", "REPEATED") and got["i.x"] == ("INTEGER", "NULLABLE") and got["i.y"][0] == "STRING"
    assert got["j"] == ("BOOLEAN", "NULLABLE")


def test_merge_is_commutative_and_idempotent(spark):
    a = spark.createDataFrame([(json.dumps({"x": 1, "y": "a"}),)], "value string")
    b = spark.createDataFrame([(json.dumps({"x": 2.5, "z": [1]}),)], "value string")
    fa, fb = P.json_facts(a), P.json_facts(b)
    ab = {tuple(r) for r in P.merge_facts(fa.unionByName(fb)).select("path", "type", "mode").collect()}
    ba = {tuple(r) for r in P.merge_facts(fb.unionByName(fa)).select("path", "type", "mode").collect()}
    aab = {tuple(r) for r in P.merge_facts(fa.unionByName(fa).unionByName(fb)).select("path", "type", "mode").collect()}
    assert ab == ba == aab == {("x", "FLOAT", "NULLABLE"), ("y", "STRING", "NULLABLE"), ("z", "INTEGER", "REPEATED")}


def test_incremental_merge_only_widens(spark):
    existing = spark.createDataFrame([("x", "INTEGER", "NULLABLE"), ("old", "STRING", "NULLABLE")],
                                     "path string, type string, mode string")
    new = P.json_facts(spark.createDataFrame([(json.dumps({"x": 1.5, "n": True}),)], "value string"))
    got = {r["path"]: r["type"] for r in P.merge_schema(existing, new).collect()}
    assert got == {"x": "FLOAT", "old": "STRING", "n": "BOOLEAN"}


def test_drift_and_resolve(spark):
    old = spark.createDataFrame([("a", "STRING", "NULLABLE"), ("b", "INTEGER", "NULLABLE")], "path string, type string, mode string")
    new = spark.createDataFrame([("b", "FLOAT", "NULLABLE"), ("c", "STRING", "REPEATED")], "path string, type string, mode string")
    got = {r["path"]: r["change"] for r in P.drift(old, new).collect()}
    assert got == {"a": "removed", "b": "type_changed", "c": "added"}
    cat = spark.createDataFrame([("works", "20260203", 2, "p1"), ("works", "20241125", 1, "p2"),
                                 ("works", "20260203", 1, "p3"), ("authors", "20241125", 1, "p4")],
                                "dataset string, version string, pattern_rank int, path string")
    got = {r["dataset"]: r["path"] for r in P.resolve_schema(cat, "20260203").collect()}
    assert got == {"works": "p3", "authors": "p4"}


def test_schema_json_roundtrip_all_datasets(spark):
    for ds in DATASETS:
        st = table_schema(ds)
        text = schemas.dumps(st)
        back = schemas.struct_from_json(text)
        assert schemas.dumps(back) == text
        assert sorted(p for p, _, _ in schemas.flatten(back)) == sorted(p for p, _, _ in schemas.flatten(st))
    works = table_schema("works")
    assert len(works.fields) == 51


def test_profile_to_struct(spark):
    lines = spark.createDataFrame([(json.dumps({"b": [{"y": 1}], "a": "x"}),)], "value string")
    st = P.to_struct(P.merge_facts(P.json_facts(lines)))
    assert st.simpleString() == "struct<a:string,b:array<struct<y:bigint>>>"


def test_grouped_facts(spark):
    lines = spark.createDataFrame([("works", json.dumps({"a": 1})), ("authors", json.dumps({"a": "x"})),
                                   ("works", json.dumps({"a": 2.5}))], "dataset string, value string")
    got = {(r["dataset"], r["path"]): r["type"] for r in P.merge_facts(P.json_facts(lines, by=("dataset",)),
                                                                       by=("dataset",)).collect()}
    assert got == {("works", "a"): "FLOAT", ("authors", "a"): "STRING"}


def test_open_maps_stay_opaque(spark):
    lines = spark.createDataFrame([(json.dumps({"id": "W1", "abstract_inverted_index": {"we": [0], "go": [1]}}),),
                                   (json.dumps({"id": "W2", "abstract_inverted_index": None}),)], "value string")
    got = {r["path"]: r["type"] for r in P.merge_facts(P.json_facts(lines, opaque=P.OPEN_MAPS)).collect()}
    assert got == {"id": "STRING", "abstract_inverted_index": "STRING"}


def test_merge_is_associative(spark):
    docs = [{"x": 1}, {"x": "a", "y": [1]}, {"x": 2.5, "y": {"z": True}}]
    fs = [P.json_facts(spark.createDataFrame([(json.dumps(d),)], "value string")) for d in docs]

    def merged(df):
        return {tuple(r) for r in P.merge_facts(df).select("path", "type", "mode").collect()}

    left = merged(fs[0].unionByName(fs[1]).unionByName(fs[2]))
    right = merged(fs[0].unionByName(fs[1].unionByName(fs[2])))
    assert left == right
    # merging a merged schema (as facts) with the rest gives the same result as all at once
    first_two = P.merge_facts(fs[0].unionByName(fs[1])).select("path", "type", "mode")
    assert {tuple(r) for r in P.merge_schema(first_two, fs[2]).select("path", "type", "mode").collect()} == left


def test_schema_file_roundtrip_keeps_description(spark):
    text = json.dumps([{"name": "d", "type": "DATE", "mode": "NULLABLE", "description": "%E4Y-%m-%d"},
                       {"name": "r", "type": "RECORD", "mode": "REPEATED",
                        "fields": [{"name": "x", "type": "INTEGER", "mode": "REQUIRED"}]}])
    st = schemas.struct_from_json(text)
    assert st["r"].dataType.elementType["x"].nullable is False
    assert json.loads(schemas.dumps(st)) == json.loads(text)
