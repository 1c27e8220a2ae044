"""``validate <dataset>`` (section 3.2): manifest -> pending files (J2) -> count
lines of pending files only (G1) -> ledger append (K5) -> cached + new (U1) ->
per-file status (J1, G2) -> dataset verdict (G3, G4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.operators.selection import pending
from ingot.plans.groups import GROUP_FILES, in_groups
from ingot.session import scratch_dir
from ingot.operators.validate import count_lines, merge_ledger, validate_counts, validate_summary
from ingot.sources.ledger import append_ledger, latest_status, read_ledger
from ingot.sources.listing import list_files
from ingot.sources.manifest import read_manifest, read_totals
from ingot.sources.ndjson import raw_lines
from ingot.sources.paths import logical_rel_path, metadata_path, qualify


def validate_dataset(spark: SparkSession, dataset: str, version: str, data_root: str, manifest_path: str,
                     ledger_root: str, url_prefix: str, recheck_failed: bool = False,
                     batch_id: int = 0, group_files: int = GROUP_FILES) -> tuple[DataFrame, DataFrame]:
    """Returns (per_file, summary).  ``data_root`` holds ``<dataset>/...`` files
    whose path relative to ``data_root`` equals the manifest's rel_path.

    A file counts only while it is there: cached ledger rows of files that have gone since are
    left out.  A source file without records leaves no converted output; the convert ledger
    stands for it with a count of 0."""
    manifest = read_manifest(spark, manifest_path, url_prefix).withColumn("dataset", F.lit(dataset))
    totals = read_totals(spark, manifest_path).withColumn("dataset", F.lit(dataset))
    root = f"{data_root.rstrip('/')}/{dataset}"
    ds_root = qualify(spark, root)
    prefix = F.lit(dataset + "/")
    # raw files keep their names; converted output maps back through folder=/file= partitions
    existing = list_files(spark, root).select("path", F.concat(prefix, logical_rel_path(F.col("path"), ds_root)).alias("rel_path"))
    is_converted = F.col("path").rlike("/folder=[^/]*/file=[^/]*/")
    empty = (read_ledger(spark, ledger_root, "convert", version, dataset).where("status = 'OK' AND records = 0")
             .select(F.concat(prefix, F.col("file")).alias("rel_path")).distinct())
    if existing.where(~is_converted).limit(1).count():  # raw data: every file is there itself
        empty = empty.where("false")
    empty = empty.join(existing, "rel_path", "left_anti")
    ledger = read_ledger(spark, ledger_root, "validation", version, dataset)
    if recheck_failed:
        ledger = ledger.where(F.col("status") == "OK")
    wanted = pending(manifest.join(existing, "rel_path"), ledger, on="rel_path", ledger_on="file").select("path", "rel_path", "expected")
    wanted = written_files(wanted)
    expected = wanted.select("rel_path", "expected").distinct()
    for rows in in_groups(wanted, group_files):
        names = spark.createDataFrame([(r["path"], r["rel_path"]) for r in rows], "file string, rel_path string")  # one group
        counts = count_lines(raw_lines(spark, [r["path"] for r in rows]), key="raw_path").withColumn("file", metadata_path(F.col("raw_path")))
        # start from the pending files, not from their lines: an empty file counts 0
        found = names.join(counts, "file", "left").groupBy("rel_path").agg(F.coalesce(F.sum("actual"), F.lit(0)).cast("bigint").alias("actual"))
        new = found.join(expected, "rel_path").select(F.col("rel_path").alias("file"), "actual", "expected",
                                                      F.when(F.col("actual") == F.col("expected"), "OK").otherwise("MISMATCH").alias("status"))
        append_ledger(new, ledger_root, "validation", version, dataset, batch_id)
    merged = merge_ledger(ledger, read_ledger(spark, ledger_root, "validation", version, dataset)) if recheck_failed else read_ledger(spark, ledger_root, "validation", version, dataset)
    current = latest_status(merged).select(F.col("file").alias("rel_path"), "actual")
    current = current.join(existing.select("rel_path").distinct(), "rel_path", "left_semi").unionByName(empty.select("rel_path", F.lit(0).cast("bigint").alias("actual")))
    per_file = validate_counts(current.select(F.lit(dataset).alias("dataset"), "rel_path", "actual"), manifest)
    return per_file, validate_summary(per_file, totals=totals)


def written_files(files: DataFrame) -> DataFrame:
    """A listing (one row per file) as a table, so that it is the same for all groups."""
    path = scratch_dir(files.sparkSession, "validate-files")
    files.write.parquet(path)
    return files.sparkSession.read.schema(files.schema).parquet(path)


def validate_all(spark: SparkSession, datasets: list[str], version: str, converted_root: str, raw_root: str,
                 ledger_root: str, url_prefix: str, recheck_failed: bool = False,
                 batch_id: int = 0) -> tuple[DataFrame | None, bool, list[str]]:
    """``validate <dataset...|all>``: B5 membership, A9 source choice per dataset,
    per-dataset validation, G5 overall state.

    The manifest is read from ``<raw_root>/<dataset>/manifest``.  Returns
    (summary over datasets, overall ok, datasets skipped for lack of data or manifest).
    """
    from ingot.catalog import check_datasets
    from ingot.operators.validate import overall_ok
    from ingot.session import fs_exists
    from ingot.sources.listing import choose_source

    summaries, skipped = [], []
    for ds in check_datasets(datasets):
        src = choose_source(spark, f"{converted_root.rstrip('/')}/{ds}", f"{raw_root.rstrip('/')}/{ds}")
        manifest = f"{raw_root.rstrip('/')}/{ds}/manifest"
        if src is None or not fs_exists(spark, manifest):
            skipped.append(ds)
            continue
        data_root = src.rstrip("/").rsplit("/", 1)[0]
        _, summary = validate_dataset(spark, ds, version, data_root, manifest, ledger_root, url_prefix,
                                      recheck_failed, batch_id)
        summaries.append(summary)
    if not summaries:
        return None, not skipped, skipped
    out = summaries[0]
    for s in summaries[1:]:
        out = out.unionByName(s)
    return out, overall_ok(out) and not skipped, skipped
