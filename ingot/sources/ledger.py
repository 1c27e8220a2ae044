"""Ledgers (A6): append-only per-file status tables.

Kinds: ``validation`` (file, actual, expected, status), ``upload`` (file, destination, status),
``convert`` (file, records, status) and ``content`` (file, records, two fingerprints, status).  Stored as Parquet partitioned by kind, version,
dataset; the TSV form of the reference can be read too.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.session import fs_exists

LEDGER_DDL = {
    "validation": "file string, actual bigint, expected bigint, status string",
    "upload": "file string, destination string, status string",
    "convert": "file string, records bigint, status string",
    "content": "file string, records bigint, f1 string, f2 string, status string",
}

RUN_DDL = ", batch bigint, written bigint"
_last_written = 0


def next_written() -> int:
    """A write time in nanoseconds that grows with each append of this driver."""
    global _last_written
    _last_written = max(time.time_ns(), _last_written + 1)
    return _last_written


def ledger_path(root: str, kind: str, version: str, dataset: str) -> str:
    return f"{root}/kind={kind}/version={version}/dataset={dataset}"


def read_ledger(spark: SparkSession, root: str, kind: str, version: str, dataset: str) -> DataFrame:
    """Ledger rows of one (kind, version, dataset); empty when none were written."""
    path = ledger_path(root, kind, version, dataset)
    if not fs_exists(spark, path):
        return spark.createDataFrame([], LEDGER_DDL[kind] + RUN_DDL)
    return spark.read.schema(LEDGER_DDL[kind] + RUN_DDL).parquet(path)


def read_ledger_tsv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The reference's TSV ledger, header line skipped."""
    return (spark.read.schema(LEDGER_DDL[kind]).option("sep", "\t").option("header", True).csv(path))


def append_ledger(rows: DataFrame, root: str, kind: str, version: str, dataset: str, batch: int = 0) -> None:
    """Append one batch of ledger rows (K5); Spark's commit protocol replaces the lock."""
    cols = [c.split()[0] for c in LEDGER_DDL[kind].split(", ")]
    (rows.select(*cols, F.lit(batch).cast("bigint").alias("batch"), F.lit(next_written()).alias("written"))
     .write.mode("append").parquet(ledger_path(root, kind, version, dataset)))


def latest_status(ledger: DataFrame) -> DataFrame:
    """Last status per file - the ledger's current view.  Rows are ordered by batch, then by
    the time of their append, which no two appends share."""
    last = F.struct("batch", F.coalesce("written", F.lit(0))) if "written" in ledger.columns else F.struct("batch")
    return (ledger.groupBy("file")
            .agg(F.max_by(F.struct(*[c for c in ledger.columns if c not in ("file", "written")]), last).alias("_l"))
            .select("file", "_l.*"))
