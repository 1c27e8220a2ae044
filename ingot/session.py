"""Session helpers: a configured SparkSession and a shared scratch area.

Scratch data always lives under the shared folder the cluster names in
``spark.checkpoint.dir`` (or the context's checkpoint directory).  Where neither is set, a
local session (tests, a laptop) gets a folder of its own; on a cluster the caller gets an
error, for a folder of the driver's own would not be seen by the executors.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # gzip NDJSON is unsplittable: one task per file; keep parquet splits modest.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # first-N selections keep their partial limit for any N in use here
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def get_spark(app: str = "ingot", master: str | None = None, shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder for scratch data and lineage cuts."""
    sc = spark.sparkContext
    root = None
    try:
        root = sc.getCheckpointDir()
    except Exception:  # pragma: no cover - older contexts
        root = None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if root:
            sc.setCheckpointDir(root)
    if not root:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ingot-ckpt-"))  # one process on one machine: tests, a laptop
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared root (not created)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_root(spark: SparkSession) -> str:
    """The application's own part of the shared folder."""
    return f"{shared_root(spark)}/ingot-scratch/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Removes all scratch data of this application, once its results are written elsewhere."""
    fs_delete(spark, scratch_root(spark))


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for one read or write; the old value comes back."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)


def few_listers(spark: SparkSession):
    """Listings inside deal their folders to a few tasks for each core, where Spark starts one for each folder
    (up to 10,000), which cost far more than the listing where a folder holds a file."""
    return setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * spark.sparkContext.defaultParallelism))


def fs_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def fs_write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small control document (schema file, manifest) through Hadoop FS."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def fs_read_text(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.open(jpath)
    try:
        data = jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


def fs_rename(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename that replaces an existing target in one step (no moment without a file)."""
    jvm = spark.sparkContext._jvm
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(s.toUri() if s.toUri().getScheme() else jvm.java.net.URI("file:///"), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(s, d, options)
    return True


def fs_create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small document under a name that must be new: False if it is taken.  Of several
    writers of one name a single one gets True, and readers see the whole document or none: it is written
    aside and takes its name by a rename that does not replace (on a local disk by a hard link)."""
    jvm = spark.sparkContext._jvm
    aside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    fs_write_text(spark, aside, text)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    s, d = jvm.org.apache.hadoop.fs.Path(aside), jvm.org.apache.hadoop.fs.Path(path)
    fs = s.getFileSystem(conf)
    try:
        if fs.getScheme() == "file":
            try:
                os.link(s.toUri().getPath(), d.toUri().getPath())
            except FileExistsError:
                return False
            return True
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(s).toUri(), conf)
        try:
            context.rename(s, d, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception):
                return False
            raise
        return True
    finally:
        fs_delete(spark, aside)


def fs_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of control documents; none if there is no such folder."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def fs_delete(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True))


__all__ = ["get_spark", "shared_root", "scratch_dir", "fs_exists",
           "fs_write_text", "fs_read_text", "fs_rename", "fs_create_new", "fs_names", "fs_delete",
           "scratch_root", "clear_scratch"]
