"""Driver stand-ins that drive whole plans over files: conversion with a broken file and a
rerun, validation with files that go, publishing, strict scans and loads, schema files, ledgers."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot import schemas
from ingot.operators.profile import profile_schema
from ingot.operators.repair import UNWIRED, Ctx
from ingot.operators.strict import strict_parse
from ingot.operators.validate import overall_ok
from ingot.plans.convert import convert
from ingot.plans.publish import publish_files
from ingot.plans.validate import validate_dataset
from ingot.session import fs_delete, fs_write_text, scratch_dir
from ingot.sinks.ndjson import write_lines, write_ndjson
from ingot.sinks.schema_file import write_schema_file
from ingot.sources.heads import head_lines
from ingot.sources.ledger import append_ledger, latest_status, read_ledger, read_ledger_tsv
from ingot.sources.listing import choose_source, list_files
from ingot.sources.ndjson import parse_records, raw_lines, with_names
from ingot.sources.paths import metadata_path, parent_dir
from ingot.sources.schema_files import read_schema_file


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources-shaped lines of the suppliers, a folder for each nation."""
    s = table(spark, sf_dir, "supplier")
    body = F.to_json(F.struct(F.concat(F.lit("S"), F.col("s_suppkey")).alias("id"), F.array("s_name", F.lit(None).cast("string")).alias("alternate_titles")))
    return s.select(body.alias("value"), F.concat(F.lit("n="), F.col("s_nationkey")).alias("folder"))


def q_convert_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources are strict: a file with a broken line and a file that is no gzip fail alone, the
    rest is committed; after the repair a second run converts just these."""
    root = scratch_dir(spark, "convert_resume")
    raw, args = f"{root}/raw/sources", ("sources", "v1", f"{root}/raw", f"{root}/converted", f"{root}/ledger")
    write_lines(_sources(spark, sf_dir), raw, partition_by="folder")
    broken = spark.createDataFrame([('{"id": "X1"}',), ('{"id": ',)], "value string").coalesce(1)
    write_lines(broken, f"{raw}/folder=broken")
    fs_write_text(spark, f"{raw}/folder=noise/part-0.gz", "this is no gzip file")
    one = convert(spark, *args, group_files=7)
    for gone in ("broken", "noise"):
        fs_delete(spark, f"{raw}/folder={gone}")
    write_lines(broken.limit(1), f"{raw}/folder=broken")
    two = convert(spark, *args, batch_id=1)
    three = convert(spark, *args, batch_id=2)
    out = with_names(raw_lines(spark, f"{root}/converted/sources"), spark, f"{root}/converted/sources")
    n = out.agg(F.count("*").alias("n_out"), F.sum(F.size(F.from_json(F.get_json_object("value", "$.alternate_titles"), "array<string>"))).alias("n_titles"))
    runs = [(i, r["failed"], r["records"], r["files"] - r["skipped"] > 0) for i, r in enumerate((one, two, three), 1)]
    ledger = latest_status(read_ledger(spark, f"{root}/ledger", "convert", "v1", "sources")).where("status = 'OK'").agg(F.sum("records").cast("bigint").alias("ledger_records"))
    return spark.createDataFrame(runs, "run int, failed int, records bigint, had_work boolean").join(n).join(ledger)


def q_strict_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strict scan reads good lines and fails on a bad one (A2)."""
    root = scratch_dir(spark, "strict_scan")
    o = table(spark, sf_dir, "orders").select(F.to_json(F.struct("o_orderkey", "o_orderstatus")).alias("value"), "o_orderstatus")
    write_lines(o, f"{root}/good", partition_by="o_orderstatus")
    write_lines(o.select(F.when(F.col("o_orderstatus") == "P", F.expr("left(value, 9)")).otherwise(F.col("value")).alias("value")), f"{root}/bad")
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())])
    got = parse_records(raw_lines(spark, f"{root}/good").withColumnRenamed("raw_path", "file"), schema, "strict", keep=())
    try:
        parse_records(raw_lines(spark, f"{root}/bad").withColumnRenamed("raw_path", "file"), schema, "strict", keep=()).write.format("noop").mode("overwrite").save()
        refused = False
    except Exception as e:
        refused = "bad NDJSON line" in str(e)
    return got.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last")).withColumn("bad_refused", F.lit(refused))


def q_validate_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """validate twice: between the runs one counted file goes; an empty file counts 0 = 0."""
    root = scratch_dir(spark, "validate_changes")
    li = table(spark, sf_dir, "lineitem")
    _flag_files(li, f"{root}/data/lineitem")
    write_lines(spark.createDataFrame([], "value string").coalesce(1), f"{root}/data/lineitem/flag=empty/bucket=0")
    counts = li.groupBy(F.coalesce("l_returnflag", F.lit("none")).alias("flag"), F.floor(F.col("l_orderkey") / 5000).alias("bucket")).agg(F.count("*").alias("expected"))
    files = list_files(spark, f"{root}/data/lineitem", "*.gz").select(F.concat(F.lit("u/lineitem/"), "rel_path").alias("url"), *[F.regexp_extract("rel_path", f"{k}=([^/]+)", 1).alias(k) for k in ("flag", "bucket")])
    entries = files.join(counts.withColumn("bucket", F.col("bucket").cast("string")), ["flag", "bucket"], "left").select("url", F.coalesce("expected", F.lit(0).cast("bigint")).alias("expected"))
    # one document, a line per file
    doc = {"meta": {"record_count": li.count()}, "entries": [{"url": r.url, "meta": {"record_count": r.expected}} for r in entries.orderBy("url").toLocalIterator()]}
    fs_write_text(spark, f"{root}/m/lineitem/manifest", json.dumps(doc))
    args = ("lineitem", "v1", f"{root}/data", f"{root}/m/lineitem/manifest", f"{root}/ledger", "u/")
    out = []
    for run in (1, 2):
        per_file, summary = validate_dataset(spark, *args, batch_id=run)
        ok = overall_ok(summary)  # G5
        out.append(per_file.groupBy(F.regexp_extract("rel_path", "flag=([^/]+)", 1).alias("flag"), "status").agg(
            F.count("*").alias("n_files"), F.sum("actual").cast("bigint").alias("actual"), F.sum("expected").cast("bigint").alias("expected")).select(F.lit(run).alias("run"), "*", F.lit(ok).alias("all_ok")))
        out[-1] = _kept(out[-1], "validate-out")
        if run == 1:
            fs_delete(spark, f"{root}/data/lineitem/flag=R")
    return out[0].unionByName(out[1])


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def q_publish_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish with a file that is no gzip: it fails alone; destinations hold the lines."""
    root = scratch_dir(spark, "publish_files")
    write_lines(_sources(spark, sf_dir), f"{root}/src/sources", partition_by="folder")
    fs_write_text(spark, f"{root}/src/sources/folder=noise/part-0.gz", "this is no gzip file")
    t1 = publish_files(spark, "sources", "v1", f"{root}/src", f"{root}/dest", f"{root}/ledger").first()
    t2 = publish_files(spark, "sources", "v1", f"{root}/src", f"{root}/dest", f"{root}/ledger", batch_id=1).first()
    ledger = latest_status(read_ledger(spark, f"{root}/ledger", "upload", "v1", "sources"))
    lines = raw_lines(spark, f"{root}/dest/v1/sources").groupBy(parent_dir(metadata_path(F.col("raw_path"))).alias("dir")).agg(F.count("*").alias("n"))
    tail = lambda c: F.regexp_extract(c, "/sources/(folder=.*)$", 1)
    held = ledger.withColumn("at", tail("destination")).join(lines.withColumn("at", tail("dir")), "at", "left")
    return held.groupBy("status").agg(F.sum("n").cast("bigint").alias("n_lines"), F.count_if(F.col("n").isNull()).alias("n_without")).select(
        "status", "n_lines", "n_without", F.lit(t1["upload_failed"] == 1 and t2["upload_failed"] == 1 and t2["uploaded_ok"] == 0 and t2["skipped"] == t1["uploaded_ok"]).alias("retried_alone"))


def q_strict_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strictness below the top level (K4): unknown field, null array, null element."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id") % 5
    inner = (F.when(k == 0, '{"a":1,"tags":["x"]}').when(k == 1, '{"a":1,"tags":["x"],"b":2}').when(k == 2, '{"a":1,"tags":null}')
             .when(k == 3, '{"a":1,"tags":["x",null]}').otherwise("null"))
    line = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"list":[{"p":{"tags":[]}},{"p":'), inner, F.lit("}]}"))
    schema = T.DataType.fromDDL("struct<id: bigint, list: array<struct<p: struct<a: bigint, tags: array<string>>>>>")
    got = strict_parse(e.select(line.alias("value")), schema, keep=())
    return got.groupBy(F.coalesce("_bad_reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n"), F.sum("id").cast("bigint").alias("ids"))


def q_schema_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profiled schema written as a file, replaced by itself, read back and flattened (A5, H5, K7)."""
    from ingot.operators.profile import to_struct

    e = table(spark, sf_dir, "events")
    line = F.to_json(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), "event_type", F.struct(F.array("user_id").alias("ids"), F.col("value").alias("v")).alias("who")))
    st = to_struct(profile_schema(e.select(line.alias("value"), F.lit("f").alias("file"), F.lit(0).alias("block_start"), F.monotonically_increasing_id().alias("line_id")), sample=0))
    path = f"{scratch_dir(spark, 'schema_files')}/events.schema.json"
    write_schema_file(spark, st, path)
    write_schema_file(spark, st, path)
    back = read_schema_file(spark, path)
    n = e.count()
    return spark.createDataFrame([(p, t, m, n) for p, t, m in schemas.flatten(back)], "path string, type string, mode string, n bigint")


def q_ledger_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as appended Parquet (latest row wins, also within one batch id) and as TSV."""
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderkey").cast("string").alias("file"), F.col("o_custkey").alias("actual"), F.col("o_shippriority" if "o_shippriority" in o.columns else "o_custkey").alias("expected"),
                    F.lit("MISMATCH").alias("status"))
    root = scratch_dir(spark, "ledger_forms")
    append_ledger(rows, root, "validation", "v1", "orders")
    append_ledger(rows.where(F.col("actual") % 2 == 0).withColumn("status", F.lit("OK")), root, "validation", "v1", "orders")
    latest = latest_status(read_ledger(spark, root, "validation", "v1", "orders"))
    rows.write.option("sep", "\t").option("header", True).csv(f"{root}/tsv")
    tsv = read_ledger_tsv(spark, f"{root}/tsv", "validation")
    out = latest.select(F.lit("parquet").alias("form"), "status", "actual").unionByName(tsv.select(F.lit("tsv").alias("form"), "status", "actual"))
    return out.groupBy("form", "status").agg(F.count("*").alias("n"), F.sum("actual").cast("bigint").alias("actual"))


def q_unwired_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R12, R13, R14, R16 by their values on orders."""
    o = table(spark, sf_dir, "orders")
    empty = F.array().cast("array<struct<id: string>>")
    one = F.array(F.struct(F.col("o_orderpriority").alias("id")))
    prio = F.col("o_orderpriority")
    rec = o.select("o_orderkey", "o_orderstatus", F.array(F.struct(F.array("o_orderstatus").alias("countries"), F.col("o_custkey").alias("n"))).alias("authorships"),
                   F.when(prio == "1-URGENT", F.lit(None)).when(prio == "2-HIGH", empty).otherwise(one).alias("host_venue"),
                   F.when(prio == "5-LOW", F.lit(None)).otherwise(one).alias("alternate_host_venues"))
    ctx = Ctx("works", T.StructType([]))
    for r in ("R12", "R14", "R16"):
        rec = UNWIRED[r](rec, ctx)
    dropped = UNWIRED["R13"](rec, ctx)
    return rec.select("o_orderkey", F.to_json("authorships").alias("authorships"), F.get("host_venue", 0)["id"].alias("venue"), F.size("host_venue").cast("bigint").alias("n_venue"),
                      F.get("alternate_host_venues", 0)["id"].alias("alternate"), F.lit(len(rec.columns) - len(dropped.columns)).cast("bigint").alias("n_dropped"))


def q_sampled_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines of each gzip file, counted in the scan (B3, H1, G8), and the choice of
    converted over raw data (A9)."""
    root = scratch_dir(spark, "sampled_heads")
    key = F.get_json_object("value", "$.l_orderkey").cast("bigint")
    _flag_files(table(spark, sf_dir, "lineitem"), f"{root}/raw/lineitem", "l_orderkey", "l_linenumber")
    src = choose_source(spark, f"{root}/converted/lineitem", f"{root}/raw/lineitem")
    obs = Observation("heads")
    heads = head_lines(spark, src, 50, tasks=16).observe(obs, F.count(F.lit(1)).alias("sampled_lines"))
    got = _kept(heads, "heads")
    out = got.groupBy(F.get_json_object("value", "$.l_returnflag").alias("flag")).agg(
        F.countDistinct("file").alias("n_files"), F.count("*").alias("n"), F.sum(key).cast("bigint").alias("keys"), F.sum("line").cast("bigint").alias("line_sum"))
    return out.withColumn("sampled", F.lit(int(obs.get["sampled_lines"])).cast("bigint"))


def _flag_files(lineitem: DataFrame, path: str, *order: str) -> None:
    """Lines of lineitem, a folder per return flag and in it a file for each run of 5,000 order keys, sorted by the
    columns ``order``.  Columns are shuffled and compared, lines are made from the sorted rows."""
    rows = lineitem.select(F.coalesce("l_returnflag", F.lit("none")).alias("flag"), F.floor(F.col("l_orderkey") / 5000).alias("bucket"), "l_returnflag", "l_orderkey", "l_linenumber")
    rows = rows.repartition("flag", "bucket").sortWithinPartitions("flag", "bucket", *order)
    write_lines(rows.select("flag", "bucket", F.to_json(F.struct("l_returnflag", "l_orderkey", "l_linenumber")).alias("value")), path, partition_by=["flag", "bucket"])


def q_overwrite_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rewritten folder replaces itself and leaves the others (K2)."""
    path = scratch_dir(spark, "overwrite")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    write_ndjson(o, path, partition_by="o_orderstatus")
    write_ndjson(o.where("o_orderstatus = 'F' AND o_orderkey % 2 = 0"), path, partition_by="o_orderstatus", mode="overwrite")
    return spark.read.json(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").cast("bigint").alias("keys"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "convert_resume": q_convert_resume, "strict_scan": q_strict_scan, "validate_changes": q_validate_changes, "publish_files": q_publish_files,
    "strict_nested": q_strict_nested, "schema_files": q_schema_files, "ledger_forms": q_ledger_forms, "unwired_rules": q_unwired_rules,
    "sampled_heads": q_sampled_heads, "overwrite_partition": q_overwrite_partition,
}

SQL = {
    "convert_resume": """
WITH n AS (SELECT count(*) AS k FROM supplier)
SELECT r.run, r.failed, CASE r.run WHEN 1 THEN k WHEN 2 THEN 1 ELSE 0 END AS records, r.run < 3 AS had_work,
       k + 1 AS n_out, CAST(k AS BIGINT) AS n_titles, CAST(k + 1 AS BIGINT) AS ledger_records
FROM n, (VALUES (1, 2), (2, 0), (3, 0)) r(run, failed)""",
    "strict_scan": "SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS last, true AS bad_refused FROM orders GROUP BY 1",
    "validate_changes": """
WITH c AS (SELECT coalesce(l_returnflag, 'none') AS flag, count(DISTINCT l_orderkey // 5000) AS n_files, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT 'empty', 1, 0)
SELECT 1 AS run, flag, 'OK' AS status, n_files, n AS actual, n AS expected, true AS all_ok FROM c
UNION ALL SELECT 2, flag, CASE WHEN flag <> 'R' THEN 'OK' ELSE 'FILE NOT FOUND' END, n_files, CASE WHEN flag <> 'R' THEN n END, n, false FROM c""",
    "publish_files": """
SELECT 'OK' AS status, count(*) AS n_lines, CAST(0 AS BIGINT) AS n_without, true AS retried_alone FROM supplier
UNION ALL SELECT 'FAIL', NULL, 1, true""",
    "strict_nested": """
SELECT CASE event_id % 5 WHEN 1 THEN 'unknown field: list.p.b' WHEN 2 THEN 'null for repeated field: list.p.tags'
       WHEN 3 THEN 'null element: list.p.tags' ELSE '' END AS reason, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
FROM events GROUP BY 1""",
    "schema_files": """
SELECT x.path, x.type, x.mode, n FROM (SELECT count(*) AS n FROM events),
  (VALUES ('event_id', 'INTEGER', 'NULLABLE'), ('event_type', 'STRING', 'NULLABLE'), ('ts', 'TIMESTAMP', 'NULLABLE'),
          ('who', 'RECORD', 'NULLABLE'), ('who.ids', 'INTEGER', 'REPEATED'), ('who.v', 'FLOAT', 'NULLABLE')) x(path, type, mode)""",
    "ledger_forms": """
SELECT 'parquet' AS form, CASE WHEN o_custkey % 2 = 0 THEN 'OK' ELSE 'MISMATCH' END AS status, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS actual FROM orders GROUP BY 2
UNION ALL SELECT 'tsv', 'MISMATCH', count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders""",
    "unwired_rules": """
SELECT o_orderkey, '[{"n":' || o_custkey || '}]' AS authorships,
       CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END AS venue, CAST(1 AS BIGINT) AS n_venue,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS alternate, CAST(2 AS BIGINT) AS n_dropped FROM orders""",
    "sampled_heads": """
WITH r AS (SELECT l_returnflag AS flag, l_orderkey, l_orderkey // 5000 AS bucket, row_number() OVER (PARTITION BY l_returnflag, l_orderkey // 5000 ORDER BY l_orderkey, l_linenumber) AS k FROM lineitem)
SELECT flag, count(DISTINCT bucket) AS n_files, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys, CAST(sum(k) AS BIGINT) AS line_sum,
       CAST(sum(count(*)) OVER () AS BIGINT) AS sampled FROM r WHERE k <= 50 GROUP BY 1""",
    "overwrite_partition": """
SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0 GROUP BY 1""",
}
