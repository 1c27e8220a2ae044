"""Gzip NDJSON writer (K1, K2).

Nulls are written (``ignoreNullFields=false``) so that repaired placeholders
survive; the commit protocol makes each job atomic.  Output file names are
Spark's; the folder tree is kept through ``partitionBy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_ndjson(df: DataFrame, path: str, partition_by: str | list[str] | None = None,
                 mode: str = "errorifexists", compression: str = "gzip", keep_nulls: bool = True) -> None:
    """Write records as NDJSON.  ``mode="overwrite"`` with ``partition_by`` replaces
    only the partitions present in ``df`` (dynamic overwrite, K2).

    ``keep_nulls`` writes every NULL field explicitly.  Without it a placeholder
    element is written as ``{}`` and absent fields are left out; any reader that
    applies a schema (and the warehouse load) reads both forms the same, and the
    output stays close to the input's size instead of carrying every schema path.
    """
    w = (df.write.mode(mode).option("compression", compression)
         .option("ignoreNullFields", "false" if keep_nulls else "true"))
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        w = w.partitionBy(*cols)
        if mode == "overwrite":
            w = w.option("partitionOverwriteMode", "dynamic")
    w.json(path)


def write_lines(df: DataFrame, path: str, partition_by: str | list[str] | None = None,
                mode: str = "errorifexists", compression: str = "gzip") -> None:
    """Write a single ``value`` string column as text lines (raw NDJSON)."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        w = w.partitionBy(*cols)
        if mode == "overwrite":
            w = w.option("partitionOverwriteMode", "dynamic")
    w.text(path)


def partition_dir(spark: SparkSession, path: str, folder: str, file: str) -> str:
    """Where ``partition_by=["folder", "file"]`` puts a file's lines."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{path.rstrip('/')}/folder={escape(folder) if folder else '__HIVE_DEFAULT_PARTITION__'}/file={escape(file)}"
