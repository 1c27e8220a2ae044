"""Repair rules, one row per branch (FIXTURES section 2)."""

import json

from pyspark.sql import functions as F

from ingot.catalog import table_schema
from ingot.operators.contract import contract_check
from ingot.operators.repair import UNWIRED, Ctx, conform, read_schema, repair, rules_for
from ingot.sources.ndjson import parse_records


def _works(spark, *recs):
    lines = spark.createDataFrame([(json.dumps(r),) for r in recs], "value string")
    return parse_records(lines, read_schema("works"), "tolerant", keep=())


def _by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_r1_apc_list_branches(spark):
    df = repair(_works(spark, {"id": "a"}, {"id": "b", "apc_list": None}, {"id": "c", "apc_list": []},
                       {"id": "d", "apc_list": {"value": 10, "currency": "EUR"}},
                       {"id": "e", "apc_list": [{"value": 10}, {"value": 20}]}), "works")
    r = _by_id(df.select("id", "apc_list"))
    for k in "abc":
        assert len(r[k]["apc_list"]) == 1 and all(v is None for v in r[k]["apc_list"][0].asDict().values())
    assert [(x["value"], x["currency"]) for x in r["d"]["apc_list"]] == [(10, "EUR")]
    assert [x["value"] for x in r["e"]["apc_list"]] == [10, 20]


def test_r1_without_placeholders(spark):
    df = repair(_works(spark, {"id": "a"}, {"id": "c", "apc_list": []}), "works", placeholders=False)
    assert all(r["apc_list"] == [] for r in df.select("apc_list").collect())


def test_r2_locations(spark):
    df = repair(_works(spark, {"id": "a"}, {"id": "b", "locations": None}, {"id": "c", "locations": []},
                       {"id": "d", "locations": [{"source": {"issn": None}}]},
                       {"id": "e", "locations": [{"source": None}]}), "works")
    r = _by_id(df.select("id", "locations"))
    for k in "ab":
        (loc,) = r[k]["locations"]
        assert loc["is_oa"] is False and loc["source"]["is_oa"] is False and loc["source"]["is_in_doaj"] is False
        assert loc["source"]["issn"] == [] and loc["license"] is None
    assert r["c"]["locations"] == []
    assert r["d"]["locations"][0]["source"]["issn"] == []
    assert r["e"]["locations"][0]["source"] is None


def test_r3_r4_location_structs(spark):
    df = repair(_works(spark, {"id": "a"}, {"id": "b", "primary_location": {"source": {"issn": None, "id": "S1"}}}),
                "works")
    r = _by_id(df.select("id", "best_oa_location", "primary_location"))
    assert r["a"]["best_oa_location"]["is_oa"] is False
    assert r["a"]["best_oa_location"]["source"]["issn"] == []
    assert r["a"]["primary_location"]["is_oa"] is False
    assert r["b"]["primary_location"]["source"]["issn"] == []
    assert r["b"]["primary_location"]["source"]["id"] == "S1"


def test_r5_authorships(spark):
    df = repair(_works(
        spark, {"id": "a"},
        {"id": "b", "authorships": [{"institutions": []}]},
        {"id": "c", "authorships": [{"institutions": [{"id": "i1", "lineage": None}],
                                     "affiliations": [{"institution_ids": None}, {"institution_ids": ["a", None]}],
                                     "countries": None, "raw_affiliation_strings": None}]}), "works")
    r = _by_id(df.select("id", "authorships"))
    assert r["a"]["authorships"] == []
    (inst,) = r["b"]["authorships"][0]["institutions"]
    assert inst["id"] is None and inst["lineage"] == []
    a = r["c"]["authorships"][0]
    assert a["institutions"][0]["lineage"] == []
    assert [x["institution_ids"] for x in a["affiliations"]] == [[], ["a"]]
    assert a["countries"] == [] and a["raw_affiliation_strings"] == []


def test_r6_top_level_arrays(spark):
    df = repair(_works(spark, {"id": "a", "referenced_works": None}), "works")
    row = df.select("corresponding_author_ids", "corresponding_institution_ids", "indexed_in",
                    "referenced_works", "related_works").first()
    assert all(v == [] for v in row)


def test_r7_stringify_keeps_source_order(spark):
    df = repair(_works(spark, {"id": "a", "abstract_inverted_index": {"we": [0, 2], "10": [1]}},
                       {"id": "b", "abstract_inverted_index": None}, {"id": "c", "abstract_inverted_index": {}}),
                "works")
    r = _by_id(df.select("id", "abstract_inverted_index"))
    assert r["a"]["abstract_inverted_index"] == '{"we":[0,2],"10":[1]}'
    assert r["b"]["abstract_inverted_index"] is None
    assert r["c"]["abstract_inverted_index"] == "{}"


def test_repair_is_idempotent(spark):
    df = repair(_works(spark, {"id": "a", "apc_list": {"value": 1}}, {"id": "b"}), "works")
    once = sorted(map(str, df.collect()))
    # a second pass over the repaired table (apc_list now an array)
    twice = sorted(map(str, repair(df, "works").collect()))
    assert once == twice


def test_contract_holds_after_repair_and_conform(spark):
    df = repair(_works(spark, {"id": "a"}, {"id": "b", "authorships": [{"institutions": None}]}), "works")
    table = conform(df, table_schema("works"))
    bad = contract_check(table, ("best_oa_location", "primary_location")).where(
        "null_arrays + null_elements + null_structs > 0").count()
    assert bad == 0


def test_r8_r9_rename_and_drop(spark):
    lines = spark.createDataFrame([(json.dumps({"id": "C1", "a-b": 1, "c": [{"d-e-f": 2}],
                                                "international": {"zh-cn": "x"}, "x": {"international": 5}}),),
                                   (json.dumps({"id": "C2", "a_b": 2, "a-b": 1}),)], "value string")
    raw = "id string, `a-b` bigint, a_b bigint, c array<struct<`d-e-f`: bigint>>, " \
          "international struct<`zh-cn`: string>, x struct<international: bigint>"
    df = parse_records(lines, __import__("pyspark.sql.types", fromlist=["T"])._parse_datatype_string(raw), keep=())
    out = df
    for rule in rules_for("concepts"):
        out = rule(out, Ctx("concepts", table_schema("concepts")))
    assert "international" not in out.columns and "a_b" in out.columns
    r = {x["id"]: x for x in out.collect()}
    assert r["C1"]["a_b"] == 1 and r["C1"]["c"][0]["d_e_f"] == 2 and r["C1"]["x"]["international"] == 5
    assert r["C2"]["a_b"] == 1


def test_r10_sources_fix_nulls(spark):
    recs = [{"id": "S1", "issn": None, "topics": [{"id": None}, None], "alternate_titles": ["x", None],
             "ids": {"issn": None}}]
    lines = spark.createDataFrame([(json.dumps(r),) for r in recs], "value string")
    df = repair(parse_records(lines, read_schema("sources"), keep=()), "sources")
    r = df.first()
    assert r["issn"] == [] and r["alternate_titles"] == ["x"] and len(r["topics"]) == 1
    assert r["ids"]["issn"] is None  # nested NULL arrays stay NULL in the reference rule


def test_unwired_rules(spark):
    df = spark.createDataFrame([("W1", [("c", ["US"])], None, [])],
                               "id string, authorships array<struct<name: string, countries: array<string>>>, "
                               "host_venue string, mesh array<struct<descriptor_ui: string>>")
    ctx = Ctx("works", table_schema("works"))
    out = UNWIRED["R12"](df, ctx)
    assert out.schema["authorships"].dataType.elementType.names == ["name"]
    out = UNWIRED["R13"](out, ctx)
    assert "host_venue" not in out.columns
    out = UNWIRED["R15b"](out, ctx)
    assert out.first()["mesh"][0]["descriptor_ui"] is None


def test_r18_reconstruct(spark):
    df = spark.createDataFrame(
        [("a", json.dumps({"IndexLength": 4, "InvertedIndex": {"we": [0, 2], "can": [1], "go": [3]}})),
         ("b", json.dumps({"IndexLength": 4, "InvertedIndex": {"we": [0], "can": [1], "go": [3]}})),
         ("c", None), ("d", json.dumps({"IndexLength": 0, "InvertedIndex": {}})),
         ("e", json.dumps({"x": [1], "y": [1]})), ("f", json.dumps({"a": [0], "b": [1]}))],
        "id string, abstract_inverted_index string")
    out = {r["id"]: r["abstract"] for r in UNWIRED["R18"](df, Ctx("works", table_schema("works"))).collect()}
    assert out == {"a": "we can we go", "b": "we can  go", "c": None, "d": None, "e": " y", "f": "a b"}


def test_institutions_read_schema_parses_hyphenated_keys(spark):
    rec = {"id": "I1", "country-code": "US", "image-url": "new", "image_url": "stale",
           "geo": {"country-code": "FR"}, "associated_institutions": [{"country-code": "DE", "display-name": "x"}],
           "international": {"display_name": {"zh-cn": "y"}}}
    lines = spark.createDataFrame([(json.dumps(rec),)], "value string")
    df = repair(parse_records(lines, read_schema("institutions"), keep=()), "institutions")
    r = df.first()
    assert (r["country_code"], r["image_url"], r["geo"]["country_code"]) == ("US", "new", "FR")
    assert r["associated_institutions"][0]["display_name"] == "x"
    assert "international" not in df.columns and "country-code" not in df.columns
