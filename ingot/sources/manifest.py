"""Manifest scan (A4): ``{meta:{record_count}, entries:[{url, meta:{record_count}}]}``.

One manifest is one JSON document per dataset, sized by the number of files
(not records), read with ``multiLine``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.sources.paths import metadata_path

MANIFEST_DDL = ("meta struct<record_count: bigint>, "
                "entries array<struct<url: string, meta: struct<record_count: bigint>>>")


def strip_prefix(url, prefix: str):
    return F.when(url.startswith(prefix), F.substring(url, len(prefix) + 1, 1 << 30)).otherwise(url)


def read_manifest(spark: SparkSession, paths: str | list[str], url_prefix: str = "") -> DataFrame:
    """Manifest entries: dataset, url, rel_path, expected, total.

    ``dataset`` is the manifest's parent directory name; ``rel_path`` is the
    url without its fixed bucket prefix (it starts with the dataset name).  A manifest without
    entries has no rows here; its total is in :func:`read_totals`.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = (spark.read.option("multiLine", True).schema(MANIFEST_DDL).json(paths)
           .select("*", metadata_path(F.col("_metadata.file_path")).alias("_mf")))
    return (raw.select(F.regexp_extract("_mf", r"([^/]+)/[^/]+$", 1).alias("dataset"),
                       F.col("meta.record_count").alias("total"),
                       F.explode("entries").alias("e"))
            .select("dataset",
                    F.col("e.url").alias("url"),
                    strip_prefix(F.col("e.url"), url_prefix).alias("rel_path"),
                    F.col("e.meta.record_count").alias("expected"),
                    "total"))


def read_totals(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(dataset, total) of each manifest, also of one without entries."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.option("multiLine", True).schema(MANIFEST_DDL).json(paths)
            .select(F.regexp_extract(metadata_path(F.col("_metadata.file_path")), r"([^/]+)/[^/]+$", 1).alias("dataset"),
                    F.col("meta.record_count").alias("total")))
