"""File listings (A7, A8, A9) as DataFrames, never as driver-side lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.session import few_listers, fs_exists
from ingot.sources.paths import base_name, first_component, normalize, qualify, relative_to

EXCLUDE_NAMES = ("manifest",)
EXCLUDE_SUFFIXES = (".tmp",)
#: Data files of a snapshot; manifests and unfinished ``*.gz.tmp`` do not match.
DATA_GLOB = "*.gz"


def list_files(spark: SparkSession, root: str, glob: str | None = None,
               exclude_names=EXCLUDE_NAMES, exclude_suffixes=EXCLUDE_SUFFIXES) -> DataFrame:
    """Recursive listing: path, rel_path, folder, name, length, modified.

    Uses the ``binaryFile`` source with only metadata columns selected, so file
    contents are pruned from the scan.  ``manifest`` and ``*.tmp`` are excluded.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    q = qualify(spark, root)
    with few_listers(spark):
        found = reader.load(root)
    df = found.select(normalize(F.col("path")).alias("path"), "length",
                                  F.col("modificationTime").alias("modified"))
    name = base_name(F.col("path"))
    cond = ~name.isin(*exclude_names) if exclude_names else F.lit(True)
    for suf in exclude_suffixes or ():
        cond = cond & ~name.endswith(suf)
    rel = relative_to(F.col("path"), q)
    return (df.where(cond)
            .select("path", rel.alias("rel_path"), first_component(rel).alias("folder"),
                    name.alias("name"), "length", "modified"))


def count_folders(files: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct folders (A7): ``countDistinct(folder)`` per group."""
    return files.groupBy(*by).agg(F.countDistinct("folder").alias("n_folders"))


def choose_source(spark: SparkSession, converted_root: str, raw_root: str) -> str | None:
    """Converted data if present, else raw (A9); None when neither exists."""
    if fs_exists(spark, converted_root):
        return converted_root
    if fs_exists(spark, raw_root):
        return raw_root
    return None
