import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import jl, write_gz
from ingot.streaming.intake import ndjson_table_handler, stream_intake

SCHEMA = T.StructType([T.StructField("i", T.LongType())])


def test_intake_only_new_files(spark, tmp_path):
    land, ck, tbl, led = (str(tmp_path / x) for x in ("land", "ck", "tbl", "led"))
    write_gz(os.path.join(land, "f1", "a.gz"), jl({"i": 1}, {"i": 2}))
    stream_intake(spark, land, ck, ndjson_table_handler(SCHEMA, tbl, led, run=1)).awaitTermination()
    write_gz(os.path.join(land, "f2", "b.gz"), jl({"i": 3}) + ["oops"])
    stream_intake(spark, land, ck, ndjson_table_handler(SCHEMA, tbl, led, run=2)).awaitTermination()
    t = spark.read.parquet(tbl)
    assert sorted((r["i"], r["run"]) for r in t.collect()) == [(1, 1), (2, 1), (3, 2)]
    ledger = {(r["file"], r["run"]): r["records"] for r in spark.read.parquet(led).collect()}
    assert ledger == {("f1/a.gz", 1): 2, ("f2/b.gz", 2): 1}


def test_entry_contract(spark):
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["rel_path", "actual", "expected", "status", "published", "apc_entries"]
    assert rows and all(r["status"] == "OK" for r in rows)


def plain(v):
    return repr(round(v, 6)) if isinstance(v, float) else str(v)


def test_queries_match_oracle_small(spark):
    """A few stand-ins against their DuckDB SQL on the smallest tables."""
    import duckdb

    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no driver tables")
    con = duckdb.connect()
    for t in ("orders", "lineitem", "events", "documents", "labels", "customer", "nation", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in ("nested_array_repair", "pending_retry_failed", "text_reconstruct", "contract_check",
                 "quoted_numbers", "schema_profile", "strict_nested", "unwired_rules", "ledger_forms"):
        df = E.queries()[name](spark, sf)
        got = sorted(tuple(map(plain, r)) for r in df.select(*sorted(df.columns)).collect())
        res = con.execute(E.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        exp = sorted(tuple(plain(r[i]) for i in order) for r in res.fetchall())
        assert sorted(df.columns) == sorted(cols), name
        assert got == exp, name


def test_intake_rerun_without_new_files_is_a_no_op(spark, tmp_path):
    land, ck, tbl, led = (str(tmp_path / x) for x in ("land", "ck", "tbl", "led"))
    write_gz(os.path.join(land, "f1", "a.gz"), jl({"i": 1}))
    write_gz(os.path.join(land, "f1", "b.gz"), jl({"i": 2}))
    q = stream_intake(spark, land, ck, ndjson_table_handler(SCHEMA, tbl, led, run=1), max_files_per_trigger=1)
    q.awaitTermination()
    assert spark.read.parquet(tbl).select("batch").distinct().count() == 2  # one file per micro-batch
    stream_intake(spark, land, ck, ndjson_table_handler(SCHEMA, tbl, led, run=2)).awaitTermination()
    t = spark.read.parquet(tbl)
    assert t.count() == 2 and t.where("run = 2").count() == 0
