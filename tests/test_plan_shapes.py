"""The scale claims in the README, checked on physical plans."""

import json

from pyspark.sql import functions as F

from conftest import jl, write_gz
from ingot.functions.text import with_index_entries
from ingot.operators import profile as P
from ingot.operators.repair import read_schema, repair
from ingot.operators.selection import head_of_files, sample_head
from ingot.operators.strict import strict_parse
from ingot.operators.validate import count_lines
from ingot.sources.ndjson import parse_records, raw_lines, with_names


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_works_repair_is_map_only(spark):
    lines = spark.createDataFrame([(json.dumps({"id": "W1"}),)], "value string")
    plan = _plan(repair(parse_records(lines, read_schema("works"), keep=()), "works"))
    assert "Exchange" not in plan


def test_sample_head_limits_before_the_shuffle(spark):
    lines = spark.createDataFrame([(f"f{i % 3}", i, i, "{}") for i in range(100)],
                                  "file string, block_start bigint, line_id bigint, value string")
    plan = _plan(sample_head(lines, 10))
    first_exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[first_exchange:] and "Partial" in plan[first_exchange:]


def test_profile_pre_aggregates_before_the_shuffle(spark):
    lines = spark.createDataFrame([(json.dumps({"a": i}),) for i in range(10)], "value string")
    plan = _plan(P.json_facts(lines))
    below = plan[plan.index("Exchange"):]
    assert "partial_sum" in below and "MapInArrow" in below


def test_text_index_has_no_shuffle(spark):
    df = spark.createDataFrame([("a b a",)], "t string")
    plan = _plan(with_index_entries(df, "t", "e").select(F.inline_outer("e")))
    assert "Exchange" not in plan


def test_heads_of_files_need_no_sort_and_no_shuffle(spark, tmp_path):
    write_gz(str(tmp_path / "d" / "a.gz"), jl(*({"i": i} for i in range(20))))
    write_gz(str(tmp_path / "d" / "b.gz"), jl({"i": 100}))
    df = head_of_files(raw_lines(spark, str(tmp_path / "d"), "*.gz"), 5)
    plan = _plan(df)
    assert "Sort" not in plan and "Exchange" not in plan
    assert sorted(json.loads(r.value)["i"] for r in df.collect()) == [0, 1, 2, 3, 4, 100]


def test_counts_group_on_the_raw_path(spark, tmp_path):
    write_gz(str(tmp_path / "d" / "a.gz"), jl({"i": 1}, {"i": 2}))
    df = with_names(count_lines(raw_lines(spark, str(tmp_path / "d")), key="raw_path"), spark, str(tmp_path / "d"))
    plan = _plan(df)
    assert "url_decode" not in plan[plan.index("Exchange"):]  # names are derived above the shuffle
    assert [(r.rel_path, r.actual) for r in df.collect()] == [("a.gz", 2)]


def test_strict_parse_lists_the_keys_once(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(f"c{i}", T.ArrayType(T.StringType())) for i in range(6)])
    plan = _plan(strict_parse(spark.createDataFrame([("{}",)], "value string"), schema, keep=()).select("_bad"))
    assert plan.count("json_object_keys") <= 2


def test_library_leaves_session_settings_alone(spark, tmp_path):
    from ingot.plans.convert import convert

    before = {k: spark.conf.get(k, None) for k in ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.optimizer.windowGroupLimitThreshold")}
    write_gz(str(tmp_path / "raw" / "sources" / "f" / "a.gz"), jl({"id": "S"}))
    convert(spark, "sources", "v1", str(tmp_path / "raw"), str(tmp_path / "c"), str(tmp_path / "l"))
    sample_head(spark.createDataFrame([("f", 1, 1, "{}")], "file string, block_start bigint, line_id bigint, value string"), 200_000).collect()
    assert before == {k: spark.conf.get(k, None) for k in before}
