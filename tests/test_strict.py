import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.operators.strict import bad_record_report, strict_parse
from ingot.sinks.table import BadRecordLimitExceeded, publish_table, read_table

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("mag", T.LongType()),
                       T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("d", T.DateType())])


def _parse(spark, *lines):
    df = spark.createDataFrame([(l, "f") for l in lines], "value string, folder string")
    return strict_parse(df, SCHEMA, keep=("folder",))


def test_k4_checks(spark):
    rows = _parse(spark, '{"id":"a","mag":"123","d":"2024-01-02"}', '{"id":"b","mag":"x1"}',
                  '{"id":"c","extra":1}', '{"id":"d","tags":"scalar"}', '{"id":"e","tags":null}',
                  '{"id":"f","tags":["t"]}', "broken", "").collect()
    got = {r["id"]: (r["_bad"], r["_bad_reason"]) for r in rows}
    assert got["a"] == (False, None)
    assert [r["mag"] for r in rows if r["id"] == "a"] == [123]
    assert got["b"] == (True, "coercion")
    assert got["c"] == (True, "unknown field: extra")
    assert got["d"] == (True, "shape")
    assert got["e"] == (True, "null for repeated field")
    assert got["f"] == (False, None)
    assert got[None] == (True, "not a JSON object")
    assert len(rows) == 7  # the blank line is skipped


def test_bad_record_limit_keeps_old_table(spark, tmp_path):
    parsed = _parse(spark, '{"id":"a"}', '{"id":"b","mag":"x"}')
    rep = bad_record_report(parsed, max_bad=0).first()
    assert (rep["n_good"], rep["n_bad"], rep["over_limit"]) == (1, 1, True)
    loc = str(tmp_path / "tables")
    publish_table(spark, parsed.drop("_bad_reason"), "works", "t1", loc, max_bad=1, bad=F.col("_bad"))
    assert read_table(spark, "works", "t1").count() == 1
    with pytest.raises(BadRecordLimitExceeded):
        publish_table(spark, parsed.drop("_bad_reason").where("id = 'b'"), "works", "t1", loc, max_bad=0,
                      bad=F.col("_bad"))
    assert [r["id"] for r in read_table(spark, "works", "t1").collect()] == ["a"]


def test_unknown_paths_at_depth(spark):
    from ingot.operators.strict import unknown_paths

    schema = T.StructType([T.StructField("id", T.StringType()),
                           T.StructField("a", T.ArrayType(T.StructType([T.StructField("x", T.LongType())])))])
    lines = spark.createDataFrame([('{"id":"1","a":[{"x":1,"y":2}],"z":{"q":1}}',), ('{"id":"2","a":[{"y":3}]}',)],
                                  "value string")
    got = {r["path"]: r["n"] for r in unknown_paths(lines, schema).collect()}
    assert got == {"a.y": 2, "z": 1, "z.q": 1}
