"""Versioned table publish (K3) with a bad-record limit.

The new data is written once to a fresh directory while an ``Observation``
counts bad rows in the same pass; only if the count is within the limit is the
table ``<dataset>_<version>`` re-pointed at the new directory (a catalog swap,
no data copy).  Otherwise the previous table stays in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ingot.catalog import table_name
from ingot.session import fs_delete


class BadRecordLimitExceeded(RuntimeError):
    pass


def publish_table(spark: SparkSession, df: DataFrame, dataset: str, version: str, location: str,
                  max_bad: int = 0, bad: Column | None = None, partition_by: list[str] | None = None,
                  drop_cols: tuple[str, ...] = ("_bad",)) -> dict:
    """Write ``df`` to ``<location>/<table>/<uuid>`` and swap the table in.

    ``bad`` (a boolean Column) marks bad rows; they are counted, never written.
    Returns ``{"table", "path", "rows", "bad"}``.  Raises
    :class:`BadRecordLimitExceeded` when ``bad > max_bad``.
    """
    name = table_name(dataset, version)
    path = f"{location.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    obs = Observation(f"publish_{name}_{uuid.uuid4().hex[:8]}")
    flag = bad if bad is not None else F.lit(False)
    staged = df.withColumn("_bad", flag).observe(obs, F.count(F.lit(1)).alias("rows"),
                                                 F.count_if(F.col("_bad")).alias("bad"))
    keep = staged.where(~F.col("_bad")).drop(*[c for c in drop_cols if c in staged.columns])
    w = keep.write.mode("errorifexists").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    m = obs.get
    n_bad = int(m.get("bad", 0) or 0)
    if n_bad > max_bad:
        fs_delete(spark, path)
        raise BadRecordLimitExceeded(f"{name}: {n_bad} bad records > limit {max_bad}; table not replaced")
    # One catalog step replaces the table; readers see the old or the new data, never none.
    # A schema or partitioning of another shape needs a new entry.
    old = location_of(spark, name)
    if old and not partition_by and spark.table(name).schema.simpleString() == spark.read.parquet(path).schema.simpleString():
        spark.sql(f"ALTER TABLE `{name}` SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        spark.catalog.createTable(name, path=path, source="parquet")
        if partition_by:
            spark.sql(f"MSCK REPAIR TABLE `{name}`")
    if old and old.rstrip("/").rsplit("/", 2)[-2] == name:
        fs_delete(spark, old)  # the superseded copy, in this sink's own layout
    return {"table": name, "path": path, "rows": int(m.get("rows", 0) or 0) - n_bad, "bad": n_bad}


def location_of(spark: SparkSession, name: str) -> str | None:
    """Where a catalog table's files lie; None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{name}`").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def read_table(spark: SparkSession, dataset: str, version: str) -> DataFrame:
    return spark.table(table_name(dataset, version))
