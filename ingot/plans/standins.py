"""Driver stand-ins: each ingest operator applied to data Spark derives from the
driver tables (which hold no scholarly records), plus the matching DuckDB SQL.

Every stand-in reads whole tables; defects are planted by data-driven rules and
every row is processed.  Queries that need files write them under a fresh
folder of the shared scratch area and read them back through the operator under
test.  Outputs are flat, with aliased columns matching the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.functions.jsonf import unknown_keys
from ingot.functions.nested import empty_value, ensure_array, ensure_struct, at_path
from ingot.functions.text import with_index_entries, with_inverted_index, with_reconstructed_text
from ingot.operators import profile as prof
from ingot.operators.contract import contract_check
from ingot.operators.repair import (
    HYPHEN_RULES, Ctx, drop_nested, drop_top_level, fix_nulls, fix_object_or_array,
    fix_top_level_arrays, stringify,
)
from ingot.operators.selection import first_n, pending, select_batch
from ingot.operators.strict import strict_parse, tolerant_report
from ingot.operators.validate import count_lines, ledger_tallies, merge_ledger, validate_counts, validate_summary
from ingot.session import fs_rename, scratch_dir
from ingot.sinks.ndjson import write_lines, write_ndjson
from ingot.sinks.table import BadRecordLimitExceeded, publish_table, read_table
from ingot.sources.listing import count_folders, list_files
from ingot.sources.manifest import read_manifest
from ingot.sources.ndjson import parse_records, raw_lines, read_lines, read_records, with_names
from ingot.sources.paths import parent_dir
from ingot.streaming.intake import ndjson_table_handler, stream_intake

URL_PREFIX = "s3://snapshot-bucket/data/"
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_SQL = "'%Y-%m-%d %H:%M:%S.%f'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def big_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table scan; its splits follow ``spark.sql.files.maxPartitionBytes``."""
    return table(spark, sf_dir, name)


def _ts(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, TS_FMT)


def _jstr(c: Column) -> Column:
    """JSON string literal of a column (quotes and escapes via to_json)."""
    return F.regexp_extract(F.to_json(F.struct(c.cast("string").alias("s"))), r'^\{"s":(.*)\}$', 1)


def write_manifest(doc: DataFrame, path: str) -> str:
    """Write a one-row manifest document as the single file ``path`` (no driver transit)."""
    tmp = path + ".parts"
    doc.coalesce(1).write.mode("overwrite").json(tmp)  # one row by construction
    spark = doc.sparkSession
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(tmp)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = [s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")][0]
    fs_rename(spark, part, path)
    fs.delete(p, True)
    return path


# ---------------------------------------------------------------- A1, K1 ---
def q_ndjson_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "ndjson_scan")
    write_ndjson(table(spark, sf_dir, "orders"), out, partition_by="o_orderstatus")
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_totalprice", T.DoubleType()),
                           T.StructField("o_orderdate", T.TimestampNTZType()),
                           T.StructField("o_orderpriority", T.StringType())])
    recs = read_records(spark, out, schema, "tolerant", root=out)
    return recs.select("o_orderkey", "o_custkey",
                       F.regexp_extract("folder", "=(.*)$", 1).alias("o_orderstatus"),
                       "o_totalprice", _ts("o_orderdate").alias("o_orderdate"), "o_orderpriority", "folder")


# ------------------------------------------------------------ A1, B4, B7 ---
def _documents_with_defects(spark: SparkSession, sf_dir: str) -> str:
    """documents as JSON lines by source folder; every 17th id cut short, blank
    lines after every 5th id.  Returns the written root."""
    docs = table(spark, sf_dir, "documents")
    js = F.to_json(F.struct("doc_id", "text", "lang", "n_chars"))
    cut = js.substr(F.lit(1), F.floor(F.length(js) / 2).cast("int"))
    line = F.when(F.col("doc_id") % 17 == 0, cut).otherwise(js)
    lines = F.when(F.col("doc_id") % 5 == 0, F.array(line, F.lit(""))).otherwise(F.array(line))
    out = scratch_dir(spark, "documents_ndjson")
    write_lines(docs.select(F.explode(lines).alias("value"), "source"), out, partition_by="source")
    return out


DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType())])


def q_ndjson_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _documents_with_defects(spark, sf_dir)
    recs = read_records(spark, root, DOC_SCHEMA, "tolerant", root=root)
    return recs.select("doc_id", "lang", F.regexp_extract("folder", "=(.*)$", 1).alias("source"), "n_chars", "text")


def q_bad_record_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _documents_with_defects(spark, sf_dir)
    return tolerant_report(read_lines(spark, root, root=root), by=("folder",), max_bad=5)


# ------------------------------------------------------------------- K4 ---
EVENT_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                             T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                             T.StructField("value", T.DoubleType())])


def q_quoted_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers quoted for odd ids, an unparseable user id for every 101st id."""
    ev = table(spark, sf_dir, "events")
    odd = F.col("event_id") % 2 == 1
    uid = (F.when(F.col("event_id") % 101 == 0, F.lit('"n/a"'))
           .when(odd, F.concat(F.lit('"'), F.col("user_id").cast("string"), F.lit('"')))
           .otherwise(F.col("user_id").cast("string")))
    val = F.when(odd, F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))).otherwise(F.col("value").cast("string"))
    line = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"ts":"'), _ts("ts"),
                    F.lit('","user_id":'), uid, F.lit(',"event_type":'), _jstr(F.col("event_type")),
                    F.lit(',"value":'), val, F.lit("}"))
    parsed = strict_parse(ev.select(line.alias("value")), EVENT_SCHEMA, keep=())
    return parsed.select("event_id", _ts("ts").alias("ts"), "user_id", "value", "event_type", F.col("_bad").alias("bad"))


def q_unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``props`` keys spliced into the top level (plus ``trace`` on errors) are unknown fields."""
    ev = table(spark, sf_dir, "events")
    base = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    extra = F.when(F.col("event_type") == "error", F.lit(',"trace":null')).otherwise(F.lit(""))
    props_body = F.expr("substring(props, 2, length(props) - 2)")
    line = F.concat(base.substr(F.lit(1), F.length(base) - 1), F.lit(","), props_body, extra, F.lit("}"))
    lines = ev.select(line.alias("line"))
    parsed = strict_parse(lines, EVENT_SCHEMA, keep=("line",), value_col="line")
    uk = unknown_keys(F.col("line"), EVENT_SCHEMA.names)
    return parsed.select("event_id", F.array_join(uk, ",").alias("unknown_keys"),
                         F.size(uk).cast("bigint").alias("n_unknown"), F.col("_bad").alias("bad"))


# ------------------------------------------------------------------- A4 ---
def _lineitem_files(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, DataFrame]:
    li = table(spark, sf_dir, "lineitem")
    root = scratch_dir(spark, name)
    write_ndjson(li, f"{root}/lineitem", partition_by=["l_returnflag", "l_linestatus"])
    return root, li


def _group_path(ds: str, *pairs: tuple[str, Column]) -> Column:
    parts = [F.lit(ds)]
    for k, v in pairs:
        parts += [F.lit(f"/{k}="), v]
    return F.concat(*parts)


def manifest_document(entries: DataFrame, url_prefix: str, totals: DataFrame | None = None) -> DataFrame:
    """Build one manifest document from ``(rel_path, expected)`` rows.

    ``meta.record_count`` is the sum of the entries unless ``totals`` (one row,
    column ``total``) gives the dataset's own count.  The document is a single
    row by definition; its size is the number of files listed, so the one
    group holds file names, not records.
    """
    rows = entries.select("rel_path", F.col("expected").cast("bigint").alias("expected"),
                          F.lit(None).cast("bigint").alias("_total"))
    if totals is not None:
        rows = rows.unionByName(totals.select(F.lit(None).cast("string").alias("rel_path"),
                                              F.lit(None).cast("bigint").alias("expected"),
                                              F.col("total").cast("bigint").alias("_total")))
    total = F.sum("_total") if totals is not None else F.sum("expected")
    return (rows.agg(total.alias("total"),
                     F.sort_array(F.collect_list(F.when(F.col("rel_path").isNotNull(), F.struct(
                         F.concat(F.lit(url_prefix), F.col("rel_path")).alias("url"),
                         F.struct(F.col("expected").alias("record_count")).alias("meta"))))).alias("entries"))
            .select(F.struct(F.col("total").alias("record_count")).alias("meta"), "entries"))


def q_manifest_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    entries = (li.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("expected"))
               .select(F.concat(_group_path("lineitem", ("l_returnflag", F.col("l_returnflag")),
                                            ("l_linestatus", F.col("l_linestatus"))),
                                F.lit("/part-0.json.gz")).alias("rel_path"), "expected"))
    root = scratch_dir(spark, "manifest")
    path = write_manifest(manifest_document(entries, URL_PREFIX), f"{root}/lineitem/manifest")
    return read_manifest(spark, path, URL_PREFIX).select("dataset", "rel_path", "expected", "total")


# -------------------------------------------------------------- A3, G1 ---
def q_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _lineitem_files(spark, sf_dir, "file_counts")
    per_file = with_names(count_lines(raw_lines(spark, f"{root}/lineitem"), key="raw_path"), spark, f"{root}/lineitem")
    return (per_file.groupBy(parent_dir(F.col("rel_path")).alias("folder"))
            .agg(F.sum("actual").cast("bigint").alias("n_lines")))


# ------------------------------------------------------ J1, G2, G3, G4 ---
def _validation_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-folder validation of lineitem (perturbed manifest, missing entries) and
    orders (exact manifest), read back from written NDJSON."""
    root = scratch_dir(spark, "validate")
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    write_ndjson(li, f"{root}/lineitem", partition_by=["l_returnflag", "l_linestatus"])
    write_ndjson(od, f"{root}/orders", partition_by=["o_orderstatus"])

    g = li.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    li_entries = g.select(_group_path("lineitem", ("l_returnflag", F.col("l_returnflag")),
                                      ("l_linestatus", F.col("l_linestatus"))).alias("rel_path"),
                          (F.col("n") + F.when(F.col("l_returnflag") == "N", 1).otherwise(0)).alias("expected"))
    missing = (g.groupBy("l_returnflag").agg(F.sum("n").alias("expected"))
               .select(_group_path("lineitem", ("l_returnflag", F.col("l_returnflag")),
                                   ("l_linestatus", F.lit("Z"))).alias("rel_path"), "expected"))
    # the manifest's own total is the true record count, not the sum of its perturbed entries
    li_doc = manifest_document(li_entries.unionByName(missing), URL_PREFIX,
                               totals=li.agg(F.count(F.lit(1)).alias("total")))
    od_entries = (od.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("expected"))
                  .select(_group_path("orders", ("o_orderstatus", F.col("o_orderstatus"))).alias("rel_path"), "expected"))
    od_doc = manifest_document(od_entries, URL_PREFIX)
    m_li = write_manifest(li_doc, f"{root}/manifests/lineitem/manifest")
    m_od = write_manifest(od_doc, f"{root}/manifests/orders/manifest")
    manifest = read_manifest(spark, [m_li, m_od], URL_PREFIX)

    lines = raw_lines(spark, [f"{root}/lineitem", f"{root}/orders"])
    counts = (with_names(count_lines(lines, key="raw_path"), spark, root)
              .select(F.regexp_extract("rel_path", "^([^/]+)/", 1).alias("dataset"),
                      parent_dir(F.col("rel_path")).alias("rel_path"), "actual")
              .groupBy("dataset", "rel_path").agg(F.sum("actual").cast("bigint").alias("actual")))
    return validate_counts(counts, manifest)


def q_validate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validation_inputs(spark, sf_dir).select("rel_path", "actual", "expected", "status")


def q_validate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_summary(_validation_inputs(spark, sf_dir)).select(
        "dataset", "actual", "expected", "n_ok", "n_mismatch", "n_missing", "missing_records", "verdict")


# ------------------------------------------------------ J2, J3, B2, U1 ---
def _ledger_from_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    return lab.select(F.col("doc_id").alias("file"),
                      F.when(F.col("quality") == 1, "OK").otherwise("FAIL").alias("status"))


def q_pending_any_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return pending(docs, _ledger_from_labels(spark, sf_dir), on="doc_id", ledger_on="file")


def q_pending_retry_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return pending(docs, _ledger_from_labels(spark, sf_dir), on="doc_id", done_status=("OK",), ledger_on="file")


def q_pending_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = q_pending_retry_failed(spark, sf_dir)
    out = first_n(todo, 5, ["source"], [F.col("doc_id")], rank_col="rn")
    return out.select("source", "doc_id", F.col("rn").cast("bigint").alias("rn"))


def q_ledger_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old ledger (labels) plus this run's statuses for the files still pending (U1),
    tallied per source folder in one aggregate (G7)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    old = (_ledger_from_labels(spark, sf_dir).join(docs.select(F.col("doc_id").alias("file"), "source"), "file")
           .withColumn("run", F.lit("old")))
    todo = pending(docs, old, on="doc_id", done_status=("OK",), ledger_on="file")
    new = todo.select(F.col("doc_id").alias("file"), "source",
                      F.when(F.col("lang") == "de", "FAIL").otherwise("OK").alias("status"), F.lit("new").alias("run"))
    return ledger_tallies(merge_ledger(old, new), by=("source",))


# ------------------------------------------------------------ B1, W2, A7 ---
def q_batch_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("folder"))
    sel = select_batch(docs, 2, 5, folder="folder")
    return sel.select("doc_id", F.col("folder").alias("source"), F.col("folder_rank").cast("bigint").alias("folder_rank"))


def q_folder_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "folders")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    write_ndjson(docs, root, partition_by=["lang", "source"])
    files = list_files(spark, root).select(F.regexp_extract("folder", "=(.*)$", 1).alias("lang"),
                                           F.regexp_extract("rel_path", "^[^/]+/([^/]+)/", 1).alias("folder"))
    return count_folders(files, by=("lang",))


# ------------------------------------------------------------------- B3 ---
def q_sample_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_type", "event_id")
    out = first_n(ev, 100, ["event_type"], [F.col("event_id")], rank_col="rn")
    return out.select("event_type", "event_id", F.col("rn").cast("bigint").alias("rn"))


# ------------------------------------------------------- nested records ---
LINE = T.StructType([T.StructField("l_linenumber", T.IntegerType()), T.StructField("l_partkey", T.LongType()),
                     T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
                     T.StructField("flags", T.ArrayType(T.StringType()))])


def order_records(spark: SparkSession, sf_dir: str, plant: bool = True) -> DataFrame:
    """Orders as nested records: ``lines`` = the order's lineitems (1-7 per order in
    the generator, i.e. record-sized), NULL when an order has none.

    Planted defects (``plant``): ``flags`` NULL for open lines, a NULL flag for
    returnflag N, ``lines`` NULL for 5-LOW orders, a NULL element appended for
    status F, and the ``ship`` struct NULL for 1-URGENT orders.
    """
    li = big_table(spark, sf_dir, "lineitem")
    flags = (F.when(F.col("l_linestatus") == "O", F.lit(None).cast("array<string>"))
             .otherwise(F.array(F.col("l_returnflag"),
                                F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.col("l_linestatus")))))
    if not plant:
        flags = F.array(F.col("l_returnflag"), F.col("l_linestatus"))
    per_order = (li.groupBy("l_orderkey")
                 .agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber"), F.col("l_partkey"),
                                                           F.col("l_returnflag"), F.col("l_linestatus"),
                                                           flags.alias("flags")))).alias("lines")))
    od = big_table(spark, sf_dir, "orders")
    rec = od.join(per_order, od.o_orderkey == per_order.l_orderkey, "left").drop("l_orderkey")
    ship = F.struct(F.col("o_orderpriority").alias("priority"), F.array(F.col("o_orderstatus")).alias("codes"))
    if plant:
        lines = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("lines"))
        lines = F.when(F.col("o_orderstatus") == "F", F.concat(lines, F.array(F.lit(None).cast(LINE)))).otherwise(lines)
        ship = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None)).otherwise(ship)
        rec = rec.withColumn("lines", lines)
    return rec.withColumn("ship", ship)


def _flags_text(lines: Column) -> Column:
    return F.array_join(F.flatten(F.transform(lines, lambda l: F.coalesce(l.getField("flags"), F.array().cast("array<string>")))), ",")


def q_ensure_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = order_records(spark, sf_dir, plant=False)
    ctx = Ctx("orders", T.StructType(rec.schema.fields))
    fixed = fix_top_level_arrays(["lines"])(rec, ctx)
    return fixed.select("o_orderkey", F.size("lines").cast("bigint").alias("n_lines"),
                        F.array_max(F.transform("lines", lambda l: l.getField("l_linenumber"))).cast("bigint").alias("max_line"))


def q_placeholder_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = order_records(spark, sf_dir, plant=False)
    lt = rec.schema["lines"].dataType
    from ingot.functions.nested import placeholder_array
    fixed = rec.withColumn("lines", placeholder_array(F.col("lines"), lt))
    return fixed.select("o_orderkey", F.explode("lines").alias("l")).select(
        "o_orderkey", F.col("l.l_linenumber").cast("bigint").alias("l_linenumber"), F.col("l.l_partkey").alias("l_partkey"))


def q_nested_array_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2/R5-style repair on planted nulls: lines NULL -> [], NULL line elements kept
    out, per line flags NULL -> [] and NULL flags removed."""
    rec = order_records(spark, sf_dir)
    lt: T.ArrayType = rec.schema["lines"].dataType
    lines = F.filter(ensure_array(F.col("lines"), lt), lambda x: x.isNotNull())
    lines = at_path(lines, lt, "flags", lambda c, d: ensure_array(F.filter(c, lambda x: x.isNotNull()), d))
    fixed = rec.withColumn("lines", lines)
    return fixed.select("o_orderkey", F.size("lines").cast("bigint").alias("n_lines"),
                        F.aggregate("lines", F.lit(0).cast("bigint"), lambda acc, l: acc + F.size(l.getField("flags"))).alias("n_flags"),
                        _flags_text(F.col("lines")).alias("flags_text"))


def q_compact_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL elements dropped at every depth, listed top-level arrays NULL -> [],
    nested NULL arrays stay NULL."""
    rec = order_records(spark, sf_dir)
    fixed = fix_nulls(array_fields=("lines",))(rec, Ctx("orders", T.StructType(rec.schema.fields)))
    return fixed.select("o_orderkey", F.size("lines").cast("bigint").alias("n_lines"),
                        F.size(F.filter("lines", lambda l: l.getField("flags").isNull())).cast("bigint").alias("n_null_flags"),
                        F.aggregate("lines", F.lit(0).cast("bigint"),
                                    lambda acc, l: acc + F.coalesce(F.size(l.getField("flags")), F.lit(0))).alias("n_flags"),
                        _flags_text(F.col("lines")).alias("flags_text"))


def q_contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = order_records(spark, sf_dir)
    return contract_check(rec.select("o_orderkey", "lines", "ship"), required_structs=("ship",))


# ------------------------------------------------------------------- R1 ---
def q_object_or_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """props as one object (view, purchase), an array of two (click), null (error), [] (signup)."""
    ev = table(spark, sf_dir, "events")
    t = F.col("event_type")
    txt = (F.when(t == "click", F.concat(F.lit("["), F.col("props"), F.lit(","), F.col("props"), F.lit("]")))
           .when(t == "error", F.lit(None).cast("string"))
           .when(t == "signup", F.lit("[]"))
           .otherwise(F.col("props")))
    target = T.StructType([T.StructField("apc", T.ArrayType(T.StructType([T.StructField("k", T.LongType())])))])
    df = ev.select("event_id", txt.alias("apc"))
    fixed = fix_object_or_array("apc")(df, Ctx("events", target))
    return fixed.select("event_id", F.size("apc").cast("bigint").alias("n_elems"),
                        F.get("apc", 0).getField("k").alias("first_k"))


# ---------------------------------------------------------------- R3, R4 ---
def q_struct_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")  # 25 rows by definition: a proven broadcast bound
    rec = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
    nat = F.struct(F.col("n_name"), F.col("n_nationkey"), F.lit(True).alias("known"),
                   F.when(F.col("n_regionkey") == 0, F.lit(None).cast("array<string>"))
                   .otherwise(F.array(F.col("n_name"))).alias("aliases"))
    rec = rec.select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(nat).alias("nation"))
    dt = rec.schema["nation"].dataType
    fixed = ensure_struct(at_path(F.col("nation"), dt, "aliases", lambda c, d: ensure_array(c, d)),
                          empty_value(dt, {"known": False}))
    out = rec.withColumn("nation", fixed)
    return out.select("c_custkey", F.col("nation.n_name").alias("nation_name"),
                      F.col("nation.known").alias("nation_known"),
                      F.size("nation.aliases").cast("bigint").alias("n_aliases"))


# ------------------------------------------------------------------- R8 ---
def q_rename_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer records with hyphenated keys at three depths, one collision
    (``c-name`` beside a stale ``c_name``) and a top-level ``international``."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    rec = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
    js = F.to_json(F.struct(
        F.col("c_custkey").alias("c-custkey"), F.col("c_name").alias("c-name"), F.lit("stale").alias("c_name"),
        F.struct(F.col("n_name").alias("n-name"), F.col("n_nationkey").alias("n-nationkey")).alias("nation"),
        F.array(F.struct(F.col("c_mktsegment").alias("t-k"))).alias("tags"),
        F.struct(F.col("c_name").alias("zh-cn")).alias("international")))
    raw = T._parse_datatype_string(
        "`c-custkey` bigint, `c-name` string, c_name string, nation struct<`n-name`: string, `n-nationkey`: int>, "
        "tags array<struct<`t-k`: string>>, international struct<`zh-cn`: string>")
    df = rec.select(F.from_json(js, raw).alias("r")).select("r.*")
    ctx = Ctx("customers", T.StructType([]))
    for rule in HYPHEN_RULES:
        df = rule(df, ctx)
    return df.select("c_custkey", "c_name", F.col("nation.n_name").alias("n_name"),
                     F.col("nation.n_nationkey").cast("bigint").alias("n_nationkey"),
                     F.get("tags", 0).getField("t_k").alias("tag"))


# --------------------------------------------------------- R9, R12, R13 ---
def q_drop_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = order_records(spark, sf_dir, plant=False).drop("ship")
    rec = rec.select(
        "o_orderkey", "o_orderstatus",
        F.transform("lines", lambda l: l.withField("countries", F.array(l.getField("flags")[0]))).alias("lines"),
        F.struct(F.lit("x").alias("code")).alias("international"),
        F.struct(F.struct(F.col("o_orderpriority").alias("code")).alias("international")).alias("meta"),
        F.lit(None).cast("string").alias("host_venue"),
        F.array().cast("array<string>").alias("alternate_host_venues"))
    ctx = Ctx("orders", T.StructType([]))
    for fn in (drop_top_level("international"), drop_nested("lines.countries"),
               drop_top_level("host_venue", "alternate_host_venues")):
        rec = fn(rec, ctx)
    line_fields = ",".join(sorted(rec.schema["lines"].dataType.elementType.names))
    return rec.select("o_orderkey", F.col("meta.international.code").alias("intl_code_nested"),
                      F.lit(",".join(sorted(rec.columns))).alias("top_fields"),
                      F.lit(line_fields).alias("line_fields"))


# ------------------------------------------------------------------- R7 ---
def q_stringify_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    t = F.col("event_type")
    props = (F.when(t == "signup", F.lit("{}")).when(t == "error", F.lit("null")).otherwise(F.col("props")))
    line = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(', "props": '), props, F.lit("}"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("props", T.StringType())])
    recs = parse_records(ev.select(line.alias("value")), schema, "tolerant", keep=())
    fixed = stringify("props")(recs, Ctx("events", schema))
    return fixed.select("event_id", F.col("props").alias("props_text"))


# ------------------------------------------------------------------ R18 ---
def q_text_index_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # inline_outer, not inline: inline makes the optimizer infer size(entries) > 0 and push
    # it below the staged projections, which re-inlines the array expression into lambdas.
    e = (with_index_entries(docs, "text", "entries").select("doc_id", F.inline_outer("entries"))
         .where(F.col("positions").isNotNull()))
    return e.select("doc_id", "word", F.size("positions").cast("bigint").alias("n_pos"),
                    F.array_join("positions", ",").alias("positions"))


def q_text_reconstruct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index each document (bare map, or the IndexLength wrapper for German
    documents), store it as JSON text, rebuild the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    idx = with_inverted_index(docs, "text", "ix").withColumn("ix", F.to_json("ix"))
    n = F.size(F.split("text", " ", -1))
    wrapped = F.concat(F.lit('{"IndexLength":'), n.cast("string"), F.lit(',"InvertedIndex":'), F.col("ix"), F.lit("}"))
    stored = idx.select("doc_id", F.when(F.col("lang") == "de", wrapped).otherwise(F.col("ix")).alias("abstract_inverted_index"))
    return with_reconstructed_text(stored, "abstract_inverted_index", "text").select("doc_id", "text")


# --------------------------------------------------------------- H1-H4, U3 ---
def _event_json(gen: int = 1) -> Column:
    """Events rendered as JSON with mixed kinds.

    gen 1: user_id quoted for odd ids, value a number, props an object, tags [],
    note null, code an int for views and text otherwise.
    gen 2 (a later generation): user_id text ids, props.k renamed props.key,
    tags filled, note dropped, channel added.
    """
    odd = F.col("event_id") % 2 == 1
    if gen == 1:
        uid = F.when(odd, F.concat(F.lit('"'), F.col("user_id").cast("string"), F.lit('"'))).otherwise(F.col("user_id").cast("string"))
        code = F.when(F.col("event_type") == "view", F.lit("1")).otherwise(_jstr(F.concat(F.lit("x"), F.col("event_type"))))
        return F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"ts":"'), _ts("ts"),
                        F.lit('","user_id":'), uid, F.lit(',"event_type":'), _jstr(F.col("event_type")),
                        F.lit(',"value":'), F.col("value").cast("string"), F.lit(',"props":'), F.col("props"),
                        F.lit(',"tags":[],"note":null,"code":'), code, F.lit("}"))
    return F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"ts":"'), _ts("ts"),
                    F.lit('","user_id":"u'), F.col("user_id").cast("string"), F.lit('","event_type":'),
                    _jstr(F.col("event_type")), F.lit(',"value":'), F.col("value").cast("string"),
                    F.lit(',"props":{"key":'), F.get_json_object("props", "$.k"), F.lit('},"tags":['),
                    _jstr(F.col("event_type")), F.lit('],"channel":"web","code":1}'))


def q_schema_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return prof.merge_facts(prof.json_facts(ev.select(_event_json(1).alias("value"))))


def q_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema of the view/click half, merged incrementally with facts of the other half."""
    ev = table(spark, sf_dir, "events")
    first = ev.where(F.col("event_type").isin("view", "click"))
    rest = ev.where(~F.col("event_type").isin("view", "click"))
    existing = prof.merge_facts(prof.json_facts(first.select(_event_json(1).alias("value"))))
    return prof.merge_schema(existing.select("path", "type", "mode"),
                             prof.json_facts(rest.select(_event_json(1).alias("value"))))


def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    old = prof.merge_facts(prof.json_facts(ev.select(_event_json(1).alias("value"))))
    new = prof.merge_facts(prof.json_facts(ev.select(_event_json(2).alias("value"))))
    return prof.drift(old, new).select("path", "change", "old_type", "new_type", "old_mode", "new_mode")


def q_unknown_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested unknown fields (K4): the schema inferred from generation-1 event
    records, checked against generation-2 records at every depth."""
    from ingot.operators.strict import unknown_paths

    ev = table(spark, sf_dir, "events")
    schema = prof.to_struct(prof.merge_facts(prof.json_facts(ev.select(_event_json(1).alias("value")))))
    return unknown_paths(ev.select(_event_json(2).alias("value")), schema)


# ------------------------------------------------------------------- J5 ---
def schema_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema catalog derived from events: dataset = event type, version = day,
    two file-name patterns."""
    ev = table(spark, sf_dir, "events")
    cat = ev.select(F.col("event_type").alias("dataset"), F.date_format("ts", "yyyyMMdd").alias("version"),
                    F.when(F.col("user_id") % 2 == 0, 1).otherwise(2).cast("bigint").alias("pattern_rank")).distinct()
    suffix = F.when(F.col("pattern_rank") == 1, F.lit(".schema.json")).otherwise(F.lit("_schema.json"))
    return cat.withColumn("path", F.concat(F.lit("schemas/"), F.col("version"), F.lit("/"), F.col("dataset"), suffix))


def q_schema_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.resolve_schema(schema_catalog(spark, sf_dir), "20240115").select("dataset", "version", "pattern_rank", "path")


# ------------------------------------------------------------------- K3 ---
def q_table_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load orders twice (F only, then all): the second load replaces the first.
    A third load with a bad-record predicate over the limit is refused and
    leaves the table as it was."""
    od = table(spark, sf_dir, "orders")
    loc = scratch_dir(spark, "tables")
    version = loc.rsplit("-", 1)[-1]
    publish_table(spark, od.where(F.col("o_orderstatus") == "F"), "orders", version, loc, max_bad=0)
    publish_table(spark, od, "orders", version, loc, max_bad=0, bad=F.col("o_totalprice") < 0)
    try:
        publish_table(spark, od, "orders", version, loc, max_bad=0, bad=F.col("o_orderpriority") == "5-LOW")
    except BadRecordLimitExceeded:
        pass
    t = read_table(spark, "orders", version)
    return t.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"),
                                          F.round(F.sum("o_totalprice"), 2).alias("sum_totalprice"))


# ---------------------------------------------------------------- A10, K5 ---
LINEITEM_JSON = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_quantity", T.DoubleType())])


def q_intake_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files land in two rounds; each availableNow run ingests only what is new."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    root = scratch_dir(spark, "intake")
    landing, ckpt, tbl, led = f"{root}/landing", f"{root}/checkpoint", f"{root}/table", f"{root}/ledger"
    write_ndjson(li.where(F.col("l_returnflag").isin("A", "N")), landing, partition_by="l_returnflag")
    q = stream_intake(spark, landing, ckpt, ndjson_table_handler(LINEITEM_JSON, tbl, led, run=1))
    q.awaitTermination()
    # a round of broken lines and an empty file only: it must not stop the intake
    bad = li.where(F.col("l_returnflag") == "A").groupBy("l_returnflag").agg(F.lit('{"l_orderkey": 1').alias("value")).select("value", F.lit("bad").alias("l_returnflag"))
    write_lines(bad, landing, partition_by="l_returnflag", mode="append")
    write_lines(bad.where("value = ''").select("value"), f"{landing}/l_returnflag=none")
    q = stream_intake(spark, landing, ckpt, ndjson_table_handler(LINEITEM_JSON, tbl, led, run=3))
    q.awaitTermination()
    write_ndjson(li.where(~F.col("l_returnflag").isin("A", "N")), landing, partition_by="l_returnflag", mode="append")
    q = stream_intake(spark, landing, ckpt, ndjson_table_handler(LINEITEM_JSON, tbl, led, run=2))
    q.awaitTermination()
    by = [F.regexp_extract("folder", "=(.*)$", 1).alias("l_returnflag"), F.col("run").cast("bigint").alias("run")]
    t = spark.read.parquet(tbl).groupBy(*by).agg(F.count(F.lit(1)).alias("n_records"))
    files = spark.read.parquet(led).withColumn("folder", parent_dir(F.col("file"))).groupBy(*by).agg(
        F.sum("records").cast("bigint").alias("ledger_records"), F.sum("dropped").cast("bigint").alias("ledger_dropped"))
    return files.join(t, ["l_returnflag", "run"], "left").na.fill(0, ["n_records"])


# ------------------------------------------------------- works R1-R7 ---
INST_ARRAY = T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("display_name", T.StringType()),
                                       T.StructField("lineage", T.ArrayType(T.StringType()))]))


def works_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works-shaped raw records (JSON text) from orders, their lineitems, customer and nation.

    Data-driven defects: ``apc_list`` is an array of two (2-HIGH), empty (3-MEDIUM),
    absent (4-NOT SPECIFIED) or one object; ``locations`` is absent for orders
    without lineitems and ``source.issn`` is null on open lines; ``primary_location``
    only for status F, with a null ``issn``; ``best_oa_location`` only for status O,
    without a source; ``authorships`` absent for 1-URGENT, institutions empty for
    negative balances, a null institution id in affiliations, null countries;
    ``referenced_works`` absent for status P; an inverted index object.  Untouched members that no
    table schema has: ``brand_new``, ``ids.newid``, ``best_oa_location.oa_status``; a quoted number
    and a timestamp with microseconds.
    """
    od = big_table(spark, sf_dir, "orders")
    li = big_table(spark, sf_dir, "lineitem")
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")  # 25 rows: proven broadcast bound
    loc = F.struct(F.col("l_linenumber"), F.col("l_partkey"), F.col("l_returnflag"), F.col("l_linestatus"),
                   F.struct(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("id"),
                            F.when(F.col("l_linestatus") == "O", F.lit(None).cast("array<string>"))
                            .otherwise(F.array(F.col("l_returnflag"))).alias("issn")).alias("source"),
                   (F.col("l_returnflag") == "R").alias("is_oa"))
    per_order = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(loc)).alias("_locs"))
    cn = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
    rec = (od.join(per_order, od.o_orderkey == per_order.l_orderkey, "left")
           .join(cn, od.o_custkey == cn.c_custkey, "left"))
    prio, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    apc_obj = F.struct(F.floor("o_totalprice").cast("bigint").alias("value"), F.lit("USD").alias("currency"))
    apc = (F.when(prio == "2-HIGH", F.to_json(F.array(apc_obj, apc_obj)))
           .when(prio == "3-MEDIUM", F.lit("[]"))
           .when(prio == "4-NOT SPECIFIED", F.lit(None))
           .otherwise(F.to_json(apc_obj)))
    locations = F.transform("_locs", lambda x: F.struct(x.getField("source").alias("source"),
                                                        x.getField("is_oa").alias("is_oa")))
    primary = F.when(status == "F", F.struct(
        F.struct(F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("id"),
                 F.lit(None).cast("array<string>").alias("issn")).alias("source"),
        F.lit(True).alias("is_oa")))
    best = F.when(status == "O", F.struct(F.lit(True).alias("is_oa"), F.lit("gold").alias("oa_status")))
    inst = F.struct(F.concat(F.lit("I"), F.col("n_nationkey").cast("string")).alias("id"),
                    F.col("n_name").alias("display_name"), F.lit(None).cast("array<string>").alias("lineage"))
    author = F.struct(
        F.struct(F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("id"),
                 F.col("c_name").alias("display_name")).alias("author"),
        F.when(F.col("c_acctbal") < 0, F.array().cast(INST_ARRAY)).otherwise(F.array(inst)).alias("institutions"),
        F.array(F.struct(F.array(F.col("n_name"), F.lit(None).cast("string")).alias("institution_ids"),
                         F.col("c_name").alias("raw_affiliation_string"))).alias("affiliations"),
        F.lit(None).cast("array<string>").alias("countries"))
    body = F.to_json(F.struct(
        F.concat(F.lit("W"), F.col("o_orderkey").cast("string")).alias("id"),
        locations.alias("locations"), primary.alias("primary_location"), best.alias("best_oa_location"),
        F.when(prio == "1-URGENT", F.lit(None)).otherwise(F.array(author)).alias("authorships"),
        F.when(status == "P", F.lit(None)).otherwise(
            F.array(F.concat(F.lit("W"), F.col("o_custkey").cast("string")))).alias("referenced_works")))
    # splice the raw-text members (object-or-array union, open map) into the object
    extra = F.concat(F.coalesce(F.concat(F.lit(',"apc_list":'), apc), F.lit("")),
                     F.lit(',"abstract_inverted_index":{"'), prio, F.lit('":[0]}'),
                     F.lit(',"brand_new":{"x":'), F.col("o_orderkey").cast("string"), F.lit(',"y":[1,null]},"cited_by_count":"'),
                     F.col("o_custkey").cast("string"), F.lit('","updated_date":"2024-01-05T10:11:12.123456","ids":{"mag":"1","newid":"'), status, F.lit('"}'))
    line = F.concat(body.substr(F.lit(1), F.length(body) - 1), extra, F.lit("}"))
    return rec.select(line.alias("value"), F.concat(F.lit("updated_date="), status).alias("folder"))


def q_works_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The works conversion plan (listing, tolerant scan, R1-R7, NDJSON by folder,
    ledger) on works-shaped records, summarised per work."""
    from ingot.catalog import table_schema
    from ingot.plans.convert import convert

    root = scratch_dir(spark, "works_convert")
    write_lines(works_records(spark, sf_dir), f"{root}/raw/works", partition_by="folder")
    convert(spark, "works", "v1", f"{root}/raw", f"{root}/converted", f"{root}/ledger")
    texts = F.from_json("value", "brand_new string, updated_date string, ids struct<newid: string>, best_oa_location struct<oa_status: string>")
    lines = raw_lines(spark, f"{root}/converted/works").withColumn("line", F.col("value")).withColumn("texts", texts)
    w = parse_records(lines, table_schema("works"), keep=("line", "texts"))
    locs, auths = F.col("locations"), F.col("authorships")

    def total(arr, f):
        return F.aggregate(arr, F.lit(0).cast("bigint"), lambda acc, x: acc + f(x))

    return w.select(
        "id",
        F.size("apc_list").cast("bigint").alias("n_apc"),
        F.get("apc_list", 0).getField("value").alias("apc_first_value"),
        F.size(locs).cast("bigint").alias("n_locations"),
        total(locs, lambda l: F.coalesce(F.size(l.getField("source").getField("issn")), F.lit(0))).alias("n_issn"),
        total(locs, lambda l: F.when(l.getField("is_oa"), 1).otherwise(0)).alias("n_oa"),
        F.col("primary_location.source.id").alias("pl_source_id"),
        F.col("primary_location.is_oa").alias("pl_is_oa"),
        F.size("primary_location.source.issn").cast("bigint").alias("pl_n_issn"),
        F.col("best_oa_location.is_oa").alias("boa_is_oa"),
        F.col("best_oa_location.source").isNotNull().alias("boa_has_source"),
        F.size(auths).cast("bigint").alias("n_authorships"),
        total(auths, lambda a: F.size(a.getField("institutions"))).alias("n_inst"),
        total(auths, lambda a: total(a.getField("institutions"), lambda i: F.size(i.getField("lineage")))).alias("n_lineage"),
        total(auths, lambda a: total(a.getField("affiliations"), lambda x: F.size(x.getField("institution_ids")))).alias("n_aff_ids"),
        total(auths, lambda a: F.size(a.getField("countries"))).alias("n_countries"),
        F.get(F.get(auths, 0).getField("institutions"), 0).getField("id").alias("inst_id"),
        F.size("referenced_works").cast("bigint").alias("n_referenced"),
        F.col("abstract_inverted_index").alias("abstract_json"),
        F.col("texts.brand_new").alias("brand_new"),
        F.regexp_extract("line", '"cited_by_count":("?[0-9]+"?)', 1).alias("cited_text"),
        F.col("texts.updated_date").alias("updated_text"),
        F.col("texts.ids.newid").alias("ids_newid"),
        F.col("texts.best_oa_location.oa_status").alias("oa_status"))


# ---------------------------------------------------------- sources R10 ---
def sources_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources-shaped raw records from supplier and nation: ``issn`` null for
    negative balances, else with a null element; null elements in
    ``alternate_titles``, ``apc_prices`` and ``topics``; ``counts_by_year`` and
    ``host_organization_lineage`` null; a null array nested in ``ids``."""
    sup = big_table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")  # 25 rows: proven broadcast bound
    rec = sup.join(F.broadcast(nation), sup.s_nationkey == nation.n_nationkey, "left")
    nul = F.lit(None).cast("string")
    body = F.to_json(F.struct(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"),
        F.col("s_name").alias("display_name"),
        F.when(F.col("s_acctbal") < 0, F.lit(None).cast("array<string>"))
        .otherwise(F.array(F.col("s_name"), nul)).alias("issn"),
        F.array(F.col("n_name"), nul, F.col("s_name")).alias("alternate_titles"),
        F.array(F.struct(F.floor("s_acctbal").cast("bigint").alias("price"), F.lit("USD").alias("currency")),
                F.lit(None).cast("struct<price: bigint, currency: string>")).alias("apc_prices"),
        F.array(F.struct(F.concat(F.lit("T"), F.col("n_regionkey").cast("string")).alias("id"),
                         F.col("n_name").alias("display_name")),
                F.lit(None).cast("struct<id: string, display_name: string>")).alias("topics"),
        F.struct(F.lit(None).cast("array<string>").alias("issn"),
                 F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("openalex")).alias("ids"),
        F.array(F.struct(F.col("s_suppkey").cast("string").alias("n"), nul.alias("m")), F.lit(None).cast("struct<n: string, m: string>")).alias("new_list")),
        {"ignoreNullFields": "false"})
    line = F.concat(body.substr(F.lit(1), F.length(body) - 1),
                    F.lit(',"counts_by_year":null,"host_organization_lineage":null}'))
    return rec.select(line.alias("value"), F.concat(F.lit("updated_date="), F.col("n_regionkey").cast("string")).alias("folder"))


def q_sources_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources conversion (R10 via the dataset registry) through the convert plan."""
    from ingot.catalog import table_schema
    from ingot.plans.convert import convert

    root = scratch_dir(spark, "sources_convert")
    write_lines(sources_records(spark, sf_dir), f"{root}/raw/sources", partition_by="folder")
    convert(spark, "sources", "v1", f"{root}/raw", f"{root}/converted", f"{root}/ledger")
    lines = raw_lines(spark, f"{root}/converted/sources").withColumn("line", F.col("value"))
    w = parse_records(lines, table_schema("sources"), keep=("line",))
    return w.select("id",
                    F.size("issn").cast("bigint").alias("n_issn"),
                    F.size("alternate_titles").cast("bigint").alias("n_alternate_titles"),
                    F.size("apc_prices").cast("bigint").alias("n_apc_prices"),
                    F.get("apc_prices", 0).getField("price").alias("first_price"),
                    F.size("topics").cast("bigint").alias("n_topics"),
                    F.size("counts_by_year").cast("bigint").alias("n_counts_by_year"),
                    F.size("host_organization_lineage").cast("bigint").alias("n_lineage"),
                    F.col("ids.issn").isNull().alias("ids_issn_null"),
                    F.get_json_object("line", "$.new_list").alias("new_list"))


# ------------------------------------------------------- institutions R8/R9 ---
def institutions_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Institution-shaped raw records from customer and nation with hyphenated keys
    at three depths (top level, inside ``geo``, inside ``associated_institutions[]``),
    a collision (``image-url`` beside a stale ``image_url``) and an
    ``international`` open map with hyphenated language keys."""
    cust = big_table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")  # 25 rows: proven broadcast bound
    rec = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
    cid = F.col("c_custkey").cast("string")
    cc = F.substring("n_name", 1, 2)
    body = F.to_json(F.struct(
        F.concat(F.lit("I"), cid).alias("id"), F.col("c_name").alias("display_name"),
        cc.alias("country-code"), F.col("c_custkey").alias("works-count"),
        F.concat(F.lit("https://img/"), cid).alias("image-url"), F.lit("stale").alias("image_url"),
        F.struct(cc.alias("country-code"), F.col("c_mktsegment").alias("city"), F.col("c_custkey").alias("extra-mix_ed-key")).alias("geo"),
        F.array(F.struct(F.lit(2020).alias("year"), F.col("c_custkey").cast("string").alias("works-count"))).alias("counts_by_year"),
        F.lit(1).alias("display-name_acronyms"),
        F.array(F.struct(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"),
                         cc.alias("country-code"), F.col("n_name").alias("display-name"))).alias("associated_institutions"),
        F.struct(F.struct(F.col("c_name").alias("zh-cn"), F.col("n_name").alias("pt-br")).alias("display_name"))
        .alias("international")))
    return rec.select(body.alias("value"), F.concat(F.lit("updated_date="), F.col("c_mktsegment")).alias("folder"))


def q_institutions_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The institutions conversion (R8 rename at every depth, R9 drop of the top-level
    ``international``) through the dataset registry and the convert plan."""
    from ingot.catalog import table_schema
    from ingot.plans.convert import convert

    root = scratch_dir(spark, "institutions_convert")
    write_lines(institutions_records(spark, sf_dir), f"{root}/raw/institutions", partition_by="folder")
    convert(spark, "institutions", "v1", f"{root}/raw", f"{root}/converted", f"{root}/ledger")
    conv = f"{root}/converted/institutions"
    lines = raw_lines(spark, conv).withColumn("line", F.col("value"))
    # one parse per line; the raw line is kept alongside to list its top-level keys
    w = parse_records(lines, table_schema("institutions"), keep=("line",))
    first = F.get("associated_institutions", 0)
    return w.select(
        "id", "country_code", "works_count", "image_url", F.col("geo.country_code").alias("geo_country_code"),
        F.col("geo.city").alias("geo_city"), first.getField("country_code").alias("assoc_country_code"),
        first.getField("display_name").alias("assoc_display_name"),
        F.get_json_object("line", "$.geo.extra_mix_ed_key").cast("bigint").alias("geo_extra"),
        F.get_json_object("line", "$.counts_by_year").alias("counts_text"),
        F.array_join(F.sort_array(F.json_object_keys("line")), ",").alias("top_keys"))


# -------------------------------------------------------------- flagship ---
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum slice end to end: orders (with their lineitems and an
    object-or-array field) written as gzip NDJSON with planted bad lines,
    validated against a manifest built from the source table, read tolerantly
    with an explicit schema, repaired (R1, R6), published as a versioned table
    (K3) and reported per folder."""
    od = big_table(spark, sf_dir, "orders")
    li = big_table(spark, sf_dir, "lineitem")
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("line_numbers"))
    rec = od.join(lines, od.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey")
    base = F.to_json(F.struct("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "line_numbers"))
    obj = F.to_json(F.struct(F.col("o_totalprice").alias("value"), F.lit("USD").alias("currency")))
    apc = (F.when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("["), obj, F.lit(","), obj, F.lit("]")))  # array
           .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("string"))    # absent
           .otherwise(obj))                                                                       # one object
    js = F.concat(base.substr(F.lit(1), F.length(base) - 1),
                  F.coalesce(F.concat(F.lit(',"apc_list":'), apc), F.lit("")), F.lit("}"))
    bad = (F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderstatus") == "P")
    line = F.when(bad, js.substr(F.lit(1), F.floor(F.length(js) / 2).cast("int"))).otherwise(js)
    root = scratch_dir(spark, "flagship")
    write_lines(rec.select(line.alias("value"), "o_orderstatus"), f"{root}/orders", partition_by="o_orderstatus")

    entries = (od.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("expected"))
               .select(_group_path("orders", ("o_orderstatus", F.col("o_orderstatus"))).alias("rel_path"), "expected"))
    manifest = read_manifest(spark, write_manifest(manifest_document(entries, URL_PREFIX),
                                                   f"{root}/manifests/orders/manifest"), URL_PREFIX)
    raw_lines = read_lines(spark, f"{root}/orders", root=root)
    counts = (count_lines(raw_lines, key="rel_path")
              .groupBy(F.lit("orders").alias("dataset"), parent_dir(F.col("rel_path")).alias("rel_path"))
              .agg(F.sum("actual").cast("bigint").alias("actual")))
    per_file = validate_counts(counts, manifest)

    target = T._parse_datatype_string(
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string, "
        "line_numbers array<int>, apc_list array<struct<value: double, currency: string>>")
    read_schema = T.StructType([f if f.name != "apc_list" else T.StructField("apc_list", T.StringType())
                                for f in target.fields])
    obs = Observation("flagship_scan")
    recs = parse_records(raw_lines, read_schema, "tolerant", obs, keep=("rel_path",))
    ctx = Ctx("orders", target)
    fixed = fix_top_level_arrays(["line_numbers"])(fix_object_or_array("apc_list")(recs, ctx), ctx)
    fixed = fixed.withColumn("folder", parent_dir(F.col("rel_path"))).drop("rel_path")
    version = root.rsplit("-", 1)[-1]
    publish_table(spark, fixed, "orders", version, f"{root}/tables", max_bad=0, partition_by=["folder"])
    published = read_table(spark, "orders", version).groupBy(F.col("folder").alias("rel_path")).agg(
        F.count(F.lit(1)).alias("published"),
        F.sum(F.size("apc_list")).cast("bigint").alias("apc_entries"))
    return (per_file.join(published, "rel_path", "left")
            .select("rel_path", "actual", "expected", "status",
                    F.coalesce("published", F.lit(0)).cast("bigint").alias("published"),
                    F.coalesce("apc_entries", F.lit(0)).cast("bigint").alias("apc_entries")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flagship_ingest": flagship,
    "works_convert": q_works_convert,
    "sources_convert": q_sources_convert,
    "institutions_convert": q_institutions_convert,
    "ndjson_scan": q_ndjson_scan,
    "ndjson_tolerant": q_ndjson_tolerant,
    "bad_record_report": q_bad_record_report,
    "quoted_numbers": q_quoted_numbers,
    "unknown_fields": q_unknown_fields,
    "manifest_entries": q_manifest_entries,
    "file_counts": q_file_counts,
    "validate_files": q_validate_files,
    "validate_summary": q_validate_summary,
    "pending_any_status": q_pending_any_status,
    "pending_retry_failed": q_pending_retry_failed,
    "pending_first_n": q_pending_first_n,
    "ledger_union": q_ledger_union,
    "batch_range": q_batch_range,
    "folder_count": q_folder_count,
    "sample_head": q_sample_head,
    "ensure_array": q_ensure_array,
    "placeholder_array": q_placeholder_array,
    "object_or_array": q_object_or_array,
    "struct_default": q_struct_default,
    "nested_array_repair": q_nested_array_repair,
    "compact_arrays": q_compact_arrays,
    "rename_keys": q_rename_keys,
    "drop_fields": q_drop_fields,
    "stringify_map": q_stringify_map,
    "text_index_build": q_text_index_build,
    "text_reconstruct": q_text_reconstruct,
    "contract_check": q_contract_check,
    "schema_profile": q_schema_profile,
    "schema_merge": q_schema_merge,
    "schema_drift": q_schema_drift,
    "schema_resolve": q_schema_resolve,
    "unknown_paths": q_unknown_paths,
    "table_publish": q_table_publish,
    "intake_stream": q_intake_stream,
}
