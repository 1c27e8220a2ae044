"""Driver stand-ins for what outlasts a run: versions of tables, loads that stop at their limit, profiles that
follow their files, content fingerprints."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.operators.content import combined, compare, fingerprints, validate_content
from ingot.operators.profile import json_facts, merge_facts
from ingot.operators.profile_state import ProfileState
from ingot.plans.load import load_version
from ingot.plans.standins_files import _flag_files, _kept, table
from ingot.session import scratch_dir
from ingot.sinks.ndjson import write_lines
from ingot.sinks.table import BadRecordLimitExceeded
from ingot.sinks.versions import PublishConflict, TableLog, publish_version
from ingot.sources.listing import DATA_GLOB, list_files
from ingot.sources.ledger import append_ledger, read_ledger
from ingot.sources.ledger_levels import LeveledLedger
from ingot.sources.ndjson import raw_lines
from ingot.streaming.verdict import VERDICT_DDL, count_events, manifest_events, run_verdicts

ORDERS = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType())])


def q_table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versions of a table: finished ones, then all, with a column more by a racing pair of which one
    wins, rolled back, appended to; what each read sees, also one that began before the swaps."""
    o = table(spark, sf_dir, "orders")
    root = scratch_dir(spark, "table_versions")
    log = TableLog(spark, root)
    done, rest = F.col("o_orderstatus") == "F", F.coalesce(F.col("o_orderstatus") != "F", F.lit(True))
    rows = lambda where, *more: o.where(where).select(*ORDERS.names, *more, (F.col("o_orderkey") < 0).alias("_bad"))
    publish_version(spark, [rows(done)], root, ORDERS)
    early = log.read()
    publish_version(spark, [rows(done), rows(rest)], root, ORDERS)
    wide = T.StructType([*ORDERS.fields, T.StructField("o_orderstatus", T.StringType())])
    lost, start = [], threading.Barrier(2)

    def race():
        start.wait()
        try:
            publish_version(spark, [rows(rest, "o_orderstatus")], root, wide, base=2)
        except PublishConflict:
            lost.append(1)

    pair = [threading.Thread(target=race) for _ in range(2)]
    for t in pair:
        t.start()
    for t in pair:
        t.join()
    log.rollback(1)
    publish_version(spark, [rows(rest)], root, ORDERS, append=True)
    log.expire(keep=4)  # version 1 goes, its data is held by 4
    reads = [("early", early)] + [(f"version {v}", log.read(v)) for v in log.versions()]
    out = None
    for name, df in reads:
        one = df.agg(F.count("*").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).cast("bigint").alias("cents")).select(
            F.lit(name).alias("read"), "n", "cents", F.lit(len(df.columns)).alias("n_columns"), F.lit(len(lost)).alias("n_lost"))
        out = one if out is None else out.unionByName(one)
    return out


def q_load_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load over its bad-record limit stops before its last groups of files and leaves the table; one within
    the limit goes through.  Every 50th order's line is cut short."""
    root = scratch_dir(spark, "load_stops")
    o = table(spark, sf_dir, "orders")
    line = F.to_json(F.struct("o_orderkey", "o_totalprice"))
    bad = F.pmod(F.col("o_orderkey"), F.lit(50)) == 0
    lines = o.select(F.floor(F.col("o_orderkey") / 2000).alias("folder"), F.when(bad, F.expr("left(to_json(struct(o_orderkey)), 9)")).otherwise(line).alias("value"))
    write_lines(lines.repartition("folder"), f"{root}/data/orders", partition_by="folder")
    n_files, n_bad = list_files(spark, f"{root}/data/orders", DATA_GLOB).count(), o.where(bad).count()
    size = max(1, n_files // 12)
    args = (spark, "orders", "v1", f"{root}/data", ORDERS, f"{root}/tables")
    seen = []
    one = load_version(*args, max_bad=n_bad, group_files=size, progress=seen.append)
    try:
        load_version(*args, max_bad=0, group_files=size, parallel=2)
        stopped = None
    except BadRecordLimitExceeded as e:
        stopped = e.groups
    log = TableLog(spark, f"{root}/tables/orders_v1")
    return log.read().agg(F.count("*").alias("n"), F.sum("o_orderkey").cast("bigint").alias("keys")).select(
        "n", "keys", F.lit(one["bad"]).cast("bigint").alias("n_bad"), F.lit(log.latest()).cast("bigint").alias("version"),
        F.lit(stopped is not None and stopped < one["groups"]).alias("stopped_early"),
        F.lit(len(seen) == one["groups"] and seen[-1]["rows"] == one["rows"]).alias("progress_told"))


def q_profile_follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile from stored states, after files came and went, beside one from scratch: events in files of
    1,000; the first run has files 0 and 1 of each three, the second 1 and 2."""
    root = scratch_dir(spark, "profile_follows")
    e = table(spark, sf_dir, "events")
    k = F.floor(F.col("event_id") / 1000)
    # one row per kind of file: only it has its extra field, and files 0 have text for ids
    value = (F.when(k % 3 == 0, F.to_json(F.struct(F.concat(F.lit("E"), "event_id").alias("id"), F.lit(1).alias("gone"))))
             .when(k % 3 == 1, F.to_json(F.struct(F.col("event_id").alias("id"), F.array(F.struct(F.col("event_type").alias("type"))).alias("list"))))
             .otherwise(F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.lit("2020-02-02").alias("day")))))
    write_lines(e.select(k.alias("file"), value.alias("value")).repartition("file"), f"{root}/data", partition_by="file")
    files = list_files(spark, f"{root}/data", DATA_GLOB)
    third = F.regexp_extract("rel_path", "file=([0-9]+)", 1).cast("bigint") % 3
    state = ProfileState(spark, f"{root}/state", sample=0)
    state.update(files.where(third < 2))
    run = state.update(files.where(third > 0))
    lines = raw_lines(spark, f"{root}/data", DATA_GLOB).where(F.regexp_extract("raw_path", "file=([0-9]+)", 1).cast("bigint") % 3 > 0)
    fresh = merge_facts(json_facts(lines.select("value"))).select("path", F.struct("type", "mode", "n").alias("fresh"))
    return state.profile().join(fresh, "path", "full").select(
        "path", "type", "mode", "n", F.coalesce(F.struct("type", "mode", "n") == F.col("fresh"), F.lit(False)).alias("same"),
        F.lit(run["scanned"]).cast("bigint").alias("scanned"), F.lit(run["withdrawn"]).cast("bigint").alias("withdrawn"))


def q_content_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two generations of lineitem files: in every fourth file (by number) a line value is replaced, in others a line
    is left out, some are renamed; counts alone would pass the first kind."""
    root = scratch_dir(spark, "content_changes")
    li = table(spark, sf_dir, "lineitem").select(F.floor(F.col("l_orderkey") / 1000).alias("k"), "l_orderkey", "l_linenumber", "l_quantity")
    line = F.to_json(F.struct("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("q")))
    first = (F.col("l_linenumber") == 1) & (F.col("l_orderkey") == F.col("low"))
    li = li.join(li.groupBy("k").agg(F.min("l_orderkey").alias("low")), "k")
    write_lines(li.select(F.concat(F.lit("f"), "k").alias("file"), line.alias("value")).repartition("file"), f"{root}/one/lineitem", partition_by="file")
    kind = F.col("k") % 4
    new = li.where(~((kind == 1) & first)).withColumn("l_quantity", F.when((kind == 0) & first, F.col("l_quantity") + 100).otherwise(F.col("l_quantity")))
    name = F.concat(F.when(kind == 2, F.lit("g")).otherwise(F.lit("f")), "k")
    write_lines(new.select(name.alias("file"), line.alias("value")).repartition("file"), f"{root}/two/lineitem", partition_by="file")
    lines = [raw_lines(spark, f"{root}/{g}/lineitem", DATA_GLOB) for g in ("one", "two")]
    name = F.regexp_extract("raw_path", "file=([fg][0-9]+)", 1).alias("file")  # once per file, not per line
    prints = [_kept(combined(fingerprints(x, "raw_path").select(name, "records", "f1", "f2"), "file"), "content-prints") for x in lines]
    found = compare(*prints)
    whole = combined(prints[1]).join(fingerprints(lines[1].select("value", F.lit(1).alias("all")), "all").drop("all"), ["records", "f1", "f2"]).count() == 1
    validate_content(spark, "lineitem", "v1", f"{root}/one", f"{root}/ledger").count()
    again = validate_content(spark, "lineitem", "v1", f"{root}/one", f"{root}/ledger", batch_id=1).where("status <> 'SAME'").count()
    n = read_ledger(spark, f"{root}/ledger", "content", "v1", "lineitem").count()
    return found.groupBy("status").agg(F.count("*").alias("n_files"), F.sum("old_records").cast("bigint").alias("old_records"), F.sum("new_records").cast("bigint").alias("new_records"),
                                       F.count_if(F.substring("file", 2, 99) == F.substring("was", 2, 99)).alias("renamed")).select(
        "*", F.lit(whole).alias("adds_up"), F.lit(again).cast("bigint").alias("changed_on_rerun"), F.lit(n).cast("bigint").alias("ledger_rows"))


def q_continuous_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts while files arrive in three rounds: A is complete in the second, R then has a file with a wrong
    count, N waits for a late file, which the timer names, until the third."""
    root = scratch_dir(spark, "continuous_verdict")
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag").isNotNull())
    _flag_files(li, f"{root}/landing")
    entries = li.groupBy(F.col("l_returnflag").alias("dataset"), F.floor(F.col("l_orderkey") / 5000).alias("bucket")).agg(F.count("*").alias("n"))
    per = entries.groupBy("dataset").agg(F.sum("n").alias("total"), F.min("bucket").alias("low"), F.max("bucket").alias("high"))
    wrong = (F.col("dataset") == "R") & (F.col("bucket") == F.col("low"))
    entries = entries.join(per, "dataset").select("dataset", F.concat(F.lit("bucket="), "bucket").alias("rel_path"), (F.col("n") + F.when(wrong, 1).otherwise(0)).alias("expected"), "total", "bucket", "high")
    counts = raw_lines(spark, f"{root}/landing", DATA_GLOB).groupBy("raw_path").agg(F.count("*").alias("actual")).select(
        F.regexp_extract("raw_path", "flag=([^/]+)", 1).alias("dataset"), F.regexp_extract("raw_path", "(bucket=[0-9]+)", 1).alias("rel_path"), "actual")
    late = (F.col("dataset") == "N") & (F.col("bucket") == F.col("high"))
    counts = _kept(counts.join(entries.select("dataset", "rel_path", "bucket", "high"), ["dataset", "rel_path"]).withColumn(
        "round", F.when(late, 3).when(F.col("bucket") % 3 == 0, 1).otherwise(2)), "counts")
    out = None
    for k in (1, 2, 3):
        events = count_events(counts.where(F.col("round") == k))
        (events.unionByName(manifest_events(entries)) if k == 1 else events).write.mode("append").parquet(f"{root}/events")
        run_verdicts(f"{root}/events", f"{root}/out", f"{root}/checkpoint", spark, patience=1).awaitTermination()
        now = _kept(spark.read.schema(VERDICT_DDL).parquet(f"{root}/out").withColumn("round", F.lit(k)), "verdicts")  # all so far
        out = now if out is None else out.unionByName(now)
    return out.groupBy(*[c for c in out.columns if c != "round"]).agg(F.min("round").alias("round"))


def q_ledger_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per order, tried in four rounds, failed ones once more in the next; after each round the ledger is
    compacted, after the third vacuumed too.  What is pending in both forms, and the current view by status."""
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.format_string("order-%d", "o_orderkey").alias("file"))
    root = scratch_dir(spark, "ledger_levels")
    at = ("upload", "v1", "orders")
    ledger = LeveledLedger(spark, root, *at, buckets=8)
    first, failed = F.pmod("k", F.lit(4)), F.pmod("k", F.lit(7)) == 0
    found = []
    for n in range(4):
        tried = keys.where(first == n).withColumn("status", F.when(failed, "FAIL").otherwise("OK"))
        again = keys.where((first == n - 1) & failed).withColumn("status", F.when(F.pmod("k", F.lit(14)) == 0, "OK").otherwise("FAIL"))
        for part in (tried, again):
            append_ledger(part.withColumn("destination", F.col("file")), root, *at, batch=n)
        if n < 3:  # the last round stays in the tail
            ledger.compact(ratio=1)
        if n == 2:
            ledger.vacuum()
        status = ledger.latest().groupBy("status").count()
        found.append((n, ledger.pending(keys).count(), ledger.pending(keys, done_status=("OK",)).count(), {r["status"]: r["count"] for r in status.collect()}))
    return spark.createDataFrame([(n, a, r, s.get("OK", 0), s.get("FAIL", 0)) for n, a, r, s in found],
                                 "round int, n_pending bigint, n_retry bigint, n_ok bigint, n_fail bigint")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "table_versions": q_table_versions, "load_stops": q_load_stops, "profile_follows": q_profile_follows, "content_changes": q_content_changes,
    "continuous_verdict": q_continuous_verdict, "ledger_levels": q_ledger_levels,
}

SQL = {
    "table_versions": """
WITH s AS (SELECT coalesce(o_orderstatus = 'F', false) AS done, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders),
r(read, what, n_columns) AS (VALUES ('early', 1, 2), ('version 2', 3, 2), ('version 3', 2, 3), ('version 4', 1, 2), ('version 5', 3, 2))
SELECT read, count(*) AS n, CAST(sum(c) AS BIGINT) AS cents, n_columns, 1 AS n_lost FROM r, s WHERE what = 3 OR (what = 1 AND done) OR (what = 2 AND NOT done) GROUP BY read, n_columns""",
    "load_stops": """
SELECT count_if(o_orderkey % 50 <> 0) AS n, CAST(sum(CASE WHEN o_orderkey % 50 <> 0 THEN o_orderkey END) AS BIGINT) AS keys,
       count_if(o_orderkey % 50 = 0) AS n_bad, CAST(1 AS BIGINT) AS version, true AS stopped_early, true AS progress_told FROM orders""",
    "profile_follows": """
WITH k AS (SELECT event_id // 1000 AS k FROM events),
n AS (SELECT count_if(k % 3 = 1) AS one, count_if(k % 3 = 2) AS two, count(DISTINCT CASE WHEN k % 3 = 2 THEN k END) AS scanned, count(DISTINCT CASE WHEN k % 3 = 0 THEN k END) AS withdrawn FROM k)
SELECT path, type, mode, CASE c WHEN 1 THEN one WHEN 2 THEN two ELSE one + two END AS n, true AS same, scanned, withdrawn
FROM n, (VALUES ('id', 'INTEGER', 'NULLABLE', 3), ('list', 'RECORD', 'REPEATED', 1), ('list.type', 'STRING', 'NULLABLE', 1), ('day', 'DATE', 'NULLABLE', 2)) x(path, type, mode, c)
WHERE CASE c WHEN 1 THEN one WHEN 2 THEN two ELSE one + two END > 0""",
    "content_changes": """
WITH l AS (SELECT l_orderkey // 1000 AS k, l_orderkey, l_linenumber, min(l_orderkey) OVER (PARTITION BY l_orderkey // 1000) AS low FROM lineitem),
f AS (SELECT k, k % 4 AS kind, count(*) AS n, count_if(l_linenumber = 1 AND l_orderkey = low) AS hit FROM l GROUP BY 1),
s AS (SELECT CASE WHEN kind = 0 AND hit > 0 THEN 'CONTENT' WHEN kind = 1 AND hit > 0 THEN 'COUNT' WHEN kind = 2 THEN 'REMOVED' ELSE 'SAME' END AS status, n, CASE WHEN kind = 1 THEN n - hit WHEN kind <> 2 THEN n END AS m, 0 AS renamed FROM f
      UNION ALL SELECT 'ADDED', NULL, n, 1 FROM f WHERE kind = 2)
SELECT status, count(*) AS n_files, CAST(sum(n) AS BIGINT) AS old_records, CAST(sum(m) AS BIGINT) AS new_records, CAST(sum(renamed) AS BIGINT) AS renamed, true AS adds_up, CAST(0 AS BIGINT) AS changed_on_rerun,
       (SELECT 2 * count(*) FROM f) AS ledger_rows FROM s GROUP BY 1""",
    "ledger_levels": """
WITH t AS (SELECT r.round, o_orderkey % 4 <= r.round AS tried,
    (o_orderkey % 4 <= r.round AND o_orderkey % 7 <> 0) OR (o_orderkey % 4 < r.round AND o_orderkey % 14 = 0) AS ok
  FROM orders, (VALUES (0), (1), (2), (3)) r(round))
SELECT round, count(*) FILTER (NOT tried) AS n_pending, count(*) FILTER (NOT ok) AS n_retry, count(*) FILTER (ok) AS n_ok,
  count(*) FILTER (tried AND NOT ok) AS n_fail FROM t GROUP BY 1""",
    "continuous_verdict": """
WITH f AS (SELECT l_returnflag AS dataset, l_orderkey // 5000 AS b, count(*) AS n FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1, 2),
d AS (SELECT dataset, CAST(sum(n) AS BIGINT) AS n, max(b) AS high FROM f GROUP BY 1)
SELECT dataset, CASE dataset WHEN 'R' THEN 'FAIL' ELSE 'PASS' END AS verdict, CAST(NULL AS VARCHAR) AS file, n AS expected, n AS actual, CAST(0 AS BIGINT) AS n_missing,
       CAST(CASE dataset WHEN 'R' THEN 1 ELSE 0 END AS BIGINT) AS n_mismatch, CASE dataset WHEN 'N' THEN 3 ELSE 2 END AS round FROM d
UNION ALL SELECT 'N', 'MISSING', 'bucket=' || high, f.n, NULL, 1, 0, 2 FROM d JOIN f USING (dataset) WHERE dataset = 'N' AND b = high""",
}
