"""Ledger-driven publish of files (K6, re-aimed upload): pending against OK rows
(J3) -> first N (B2) -> copy lines to the destination (K1), a group of files at a time ->
statuses per file (K5) -> tallies (G7)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ingot.operators.selection import first_n, pending
from ingot.operators.validate import upload_tallies
from ingot.plans.groups import GROUP_FILES, bisected, in_groups, names_by_path, setting, split_name
from ingot.sinks.ndjson import partition_dir, write_lines
from ingot.sources.ledger import append_ledger, read_ledger
from ingot.sources.listing import list_files
from ingot.sources.ndjson import raw_lines
from ingot.sources.paths import logical_rel_path, qualify


def publish_files(spark: SparkSession, dataset: str, version: str, src_root: str, dest_root: str,
                  ledger_root: str, max_files: int = 0, batch_id: int = 0, group_files: int = GROUP_FILES):
    """Copies pending files, each to its own destination, and returns the run's tallies.  A file
    that cannot be read gets a FAIL row and is tried again by the next run; the others of its
    group go through.  The ledger names the folder that holds a file's lines (none for an
    empty file)."""
    src = f"{src_root.rstrip('/')}/{dataset}"
    dest = f"{dest_root.rstrip('/')}/{version}/{dataset}"
    root = qualify(spark, src)
    # a converted file is known by the source file it stands for
    files = list_files(spark, src).withColumn("rel_path", logical_rel_path(F.col("path"), root)).withColumn("dataset", F.lit(dataset))
    ledger = read_ledger(spark, ledger_root, "upload", version, dataset)
    todo = pending(files, ledger, on="rel_path", done_status=("OK",), ledger_on="file")
    todo = first_n(todo, max_files, ["dataset"], [F.col("path")])

    def copy(rows: list) -> list:
        names = names_by_path(spark, rows)
        lines = raw_lines(spark, [r["path"] for r in rows]).join(F.broadcast(names), "raw_path").select("value", "folder", "file")  # a row per file of the group
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "100"):
            write_lines(lines, dest, partition_by=["folder", "file"], mode="overwrite")
        return rows

    n_ok = n_fail = 0
    for rows in in_groups(todo, group_files):
        done, lost = bisected(rows, copy)
        new = [(r["rel_path"], partition_dir(spark, dest, *split_name(r["rel_path"])), "OK") for r in done] + [(name, None, "FAIL") for name in lost]
        append_ledger(spark.createDataFrame(new, "file string, destination string, status string"), ledger_root, "upload", version, dataset, batch_id)
        n_ok, n_fail = n_ok + len(done), n_fail + len(lost)
    tally = spark.createDataFrame([("OK",)] * 0, "status string")
    counts = spark.createDataFrame([(n_ok, n_fail)], "uploaded_ok bigint, upload_failed bigint")
    skipped = files.join(ledger.where("status = 'OK'").select(F.col("file").alias("rel_path")).distinct(), "rel_path", "left_semi")
    return counts.crossJoin(upload_tallies(tally, skipped.select(F.lit(1).alias("one"))).select("skipped"))


def publish_all(spark: SparkSession, datasets: list[str], version: str, converted_root: str, raw_root: str,
                dest_root: str, ledger_root: str, max_files: int = 0, batch_id: int = 0):
    """``upload <dataset...|all> [-m N]``: per dataset, converted data if present else
    raw (A9), then the ledger-driven publish.  Returns (tallies per dataset, skipped)."""
    from ingot.catalog import check_datasets
    from ingot.sources.listing import choose_source

    tallies, skipped = None, []
    for ds in check_datasets(datasets):
        src = choose_source(spark, f"{converted_root.rstrip('/')}/{ds}", f"{raw_root.rstrip('/')}/{ds}")
        if src is None:
            skipped.append(ds)
            continue
        t = publish_files(spark, ds, version, src.rstrip("/").rsplit("/", 1)[0], dest_root, ledger_root,
                          max_files, batch_id).select(F.lit(ds).alias("dataset"), "*")
        tallies = t if tallies is None else tallies.unionByName(t)
    return tallies, skipped
