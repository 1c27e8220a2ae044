"""Record-count validation against a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.functions.jsonf import is_blank


def count_lines(lines: DataFrame, key: str | list[str] = "rel_path", count_blank: bool = False) -> DataFrame:
    """Lines per file (G1): partial count per task, final count after one small shuffle.

    Blank lines are not records and are not counted unless ``count_blank``
    (the reference's ``wc -l`` counts them, but misses an unterminated last line).
    """
    keys = [key] if isinstance(key, str) else list(key)
    df = lines if count_blank else lines.where(~is_blank(F.col("value")))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("actual"))


def status_of(actual, expected):
    """OK / MISMATCH, and FILE NOT FOUND when the file was never counted."""
    return (F.when(actual.isNull(), F.lit("FILE NOT FOUND"))
            .when(actual == expected, F.lit("OK"))
            .otherwise(F.lit("MISMATCH")))


def validate_counts(counts: DataFrame, manifest: DataFrame, keys: tuple[str, ...] = ("dataset", "rel_path")) -> DataFrame:
    """Manifest LEFT JOIN counted files (J1) -> rel_path, actual, expected, status.

    Both sides have one row per file; AQE broadcasts whichever turns out small.
    """
    k = list(keys)
    return (manifest.join(counts.select(*k, "actual"), k, "left")
            .select(*k, "actual", "expected", "total",
                    status_of(F.col("actual"), F.col("expected")).alias("status")))


def validate_summary(per_file: DataFrame, by: tuple[str, ...] = ("dataset",), totals: DataFrame | None = None) -> DataFrame:
    """Per dataset: actual and expected totals, difference, counts by status, verdict.

    ``expected`` is the manifest's own total (``meta.record_count``), which may
    differ from the sum of its entries.  PASS only if no file is missing, none
    mismatched, and the totals are equal.  With ``totals`` (the group columns and ``total``)
    a manifest without entries is judged by its total alone.
    """
    g = (per_file.groupBy(*by)
         .agg(F.coalesce(F.sum("actual"), F.lit(0)).cast("bigint").alias("actual"),
              F.max("total").alias("expected"),
              F.count_if(F.col("status") == "OK").alias("n_ok"),
              F.count_if(F.col("status") == "MISMATCH").alias("n_mismatch"),
              F.count_if(F.col("status") == "FILE NOT FOUND").alias("n_missing")))
    if totals is not None:
        own = totals.select(*by, F.col("total").alias("_total"))
        g = own.join(g, list(by), "left").select(
            *by, F.coalesce("actual", F.lit(0)).cast("bigint").alias("actual"), F.coalesce("expected", "_total").alias("expected"),
            *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_ok", "n_mismatch", "n_missing")])
    return (g.withColumn("missing_records", F.col("expected") - F.col("actual"))
            .withColumn("verdict", F.when((F.col("n_missing") == 0) & (F.col("n_mismatch") == 0)
                                          & (F.col("actual") == F.col("expected")), "PASS").otherwise("FAIL")))


def overall_ok(summary: DataFrame) -> bool:
    """Exit state over datasets (G5): one boolean, collected."""
    row = summary.agg(F.coalesce(F.bool_and(F.col("verdict") == "PASS"), F.lit(True)).alias("ok")).first()
    return bool(row["ok"])


def merge_ledger(old: DataFrame, new: DataFrame) -> DataFrame:
    """Cached plus freshly counted rows, reported together."""
    return old.unionByName(new, allowMissingColumns=True)


def upload_tallies(new_rows: DataFrame, skipped: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """OK / FAIL of this run and files skipped as already done (G7), in one aggregate."""
    rows = (new_rows.select(*by, "status")
            .unionByName(skipped.select(*by, F.lit("SKIPPED").alias("status"))))
    return (rows.groupBy(*by)
            .agg(F.count_if(F.col("status") == "OK").alias("uploaded_ok"),
                 F.count_if(F.col("status") == "FAIL").alias("upload_failed"),
                 F.count_if(F.col("status") == "SKIPPED").alias("skipped")))


def ledger_tallies(merged: DataFrame, by: tuple[str, ...] = (), run_col: str = "run",
                   this_run: str = "new") -> DataFrame:
    """G7 over a merged ledger (U1) in one aggregate: OK / FAIL written by this run,
    files skipped because an earlier run had them OK, and all ledger rows."""
    new = F.col(run_col) == this_run
    st = F.col("status")
    return (merged.groupBy(*by)
            .agg(F.count_if(new & (st == "OK")).alias("uploaded_ok"),
                 F.count_if(new & (st == "FAIL")).alias("upload_failed"),
                 F.count_if(~new & (st == "OK")).alias("skipped"),
                 F.count(F.lit(1)).alias("ledger_rows")))
