"""Path arithmetic on ``_metadata.file_path`` / listing paths, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified path (``file:/...``, ``hdfs://...``, ``s3a://...``), in the
    plain (not percent-encoded) form that listings report."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return str(fs.makeQualified(p).toString()).rstrip("/")


def normalize(c: Column) -> Column:
    """``file:///x`` and ``file:/x`` name the same file; use the short form."""
    return F.regexp_replace(c, r"^file:/+", "file:/")


def metadata_path(c: Column) -> Column:
    """``_metadata.file_path`` is a percent-encoded URI; decode it to the plain path
    that listings report (``+`` is legal in a URI path, so keep it literal)."""
    return normalize(F.url_decode(F.regexp_replace(c, r"\+", "%2B")))


def relative_to(path: Column, root: str) -> Column:
    """Path relative to ``root`` (a qualified URI); the full path when outside it."""
    root_n = root.replace("file:///", "file:/")
    root_n = root_n if root_n.endswith("/") else root_n + "/"
    p = normalize(path)
    return F.when(p.startswith(root_n), F.substring(p, len(root_n) + 1, 1 << 30)).otherwise(p)


def first_component(rel: Column) -> Column:
    """Folder = first directory of a relative path ('' when the file is at the root)."""
    return F.when(F.instr(rel, "/") > 0, F.substring_index(rel, "/", 1)).otherwise(F.lit(""))


def parent_dir(rel: Column) -> Column:
    """Everything before the last '/' ('' at the root)."""
    return F.regexp_extract(rel, r"^(.*)/[^/]*$", 1)


def base_name(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def logical_rel_path(path: Column, root: str) -> Column:
    """Relative path of the *source* file a converted output file stands for.

    Converted output is laid out as ``<root>/folder=<f>/file=<name>/part-*`` (Hive
    escaping applied to the values); that maps back to ``<f>/<name>``.  Any other
    path maps to its plain relative path.
    """
    p = normalize(path)
    pat = r"/folder=([^/]*)/file=([^/]*)/[^/]*$"
    folder = F.url_decode(F.regexp_extract(p, pat, 1))
    name = F.url_decode(F.regexp_extract(p, pat, 2))
    at_root = F.regexp_extract(p, pat, 1) == "__HIVE_DEFAULT_PARTITION__"  # the empty folder
    return F.when(p.rlike(pat) & at_root, name).when(p.rlike(pat), F.concat(folder, F.lit("/"), name)).otherwise(relative_to(path, root))
