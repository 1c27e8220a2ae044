"""Work over a listing in bounded groups of files, each committed on its own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ingot.session import fs_delete, scratch_dir, setting  # noqa: F401

GROUP_FILES = 500
#: What the readers say about a file whose bytes are at fault.
DATA_ERRORS = ("ZipException", "EOFException", "MalformedInput", "incorrect header", "incorrect data check", "invalid stored block",
               "invalid block type", "invalid distance", "invalid code lengths", "not a gzip file", "FileNotFoundException", "FILE_NOT_EXIST")


def in_groups(files: DataFrame, group_files: int) -> Iterator[list]:
    """Iterates over the files (path, rel_path) in groups of ``group_files``, by path.  The
    listing is written once; the driver reads one group at a time."""
    spark = files.sparkSession
    path = scratch_dir(spark, "convert-files")
    # one row per file: ranking them orders file names, not records
    rank = F.row_number().over(Window.orderBy("path")) - 1
    files.select("path", "rel_path", F.floor(rank / group_files).alias("g")).write.parquet(path)
    listed = spark.read.parquet(path)
    n = listed.agg(F.max("g")).first()[0]
    try:
        for g in range(0 if n is None else n + 1):
            yield listed.where(F.col("g") == g).select("path", "rel_path").orderBy("path").collect()
    finally:
        fs_delete(spark, path)


def bisected(rows: list, work: Callable[[list], list]) -> tuple[list, dict[str, str]]:
    """``work`` over the files; where reading fails, over their halves, down to single files.
    Returns its results and the errors by file.  Errors that no data causes pass through."""
    try:
        return (work(rows) if rows else []), {}
    except (Py4JJavaError, PySparkException) as e:
        text = str(e)
        if not any(k in text for k in DATA_ERRORS):
            raise
        if len(rows) == 1:
            return [], {rows[0]["rel_path"]: text.strip().splitlines()[0][:300]}
        half = len(rows) // 2
        a, ea = bisected(rows[:half], work)
        b, eb = bisected(rows[half:], work)
        return a + b, ea | eb


def names_by_path(spark: SparkSession, rows: list) -> DataFrame:
    """(raw_path, folder, file) of a group's files, under every form in which the scan may
    report the path (encoded or not, one slash or three): a few rows per file."""
    to_path, out = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, set()
    for r in rows:
        for p in (r["path"], to_path(r["path"]).toUri().toString()):
            for form in {p, "file:///" + p[6:] if p.startswith("file:/") and not p.startswith("file://") else p}:
                out.add((form, *split_name(r["rel_path"])))
    return spark.createDataFrame(sorted(out), "raw_path string, folder string, file string")


def split_name(rel_path: str) -> tuple[str, str]:
    """Folder (first component, '' at the root) and the rest of a relative path."""
    folder, _, rest = rel_path.partition("/")
    return (folder, rest) if rest else ("", folder)
