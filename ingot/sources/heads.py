"""First lines of compressed files, read no further than needed.

``HeadLines`` is a batch data source: one input partition per run of files, each file opened,
decompressed until it has given ``n`` lines, and closed.  A 1 GB gzip file of which 1000 lines are
asked costs about as much as a small one, where a text scan would decompress all of it.

Files lie in a store that pyarrow opens (``file``, ``s3``, ``gs``, ``hdfs``); for any other, ``head_lines``
takes the text scan, with the same lines.
"""

from __future__ import annotations

import fnmatch
import gzip
import io
import sys

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ingot.sources.paths import metadata_path, qualify

SCHEMES = ("file", "s3", "s3a", "gs", "hdfs")
DDL = "file string, line int, value string, bytes_read long"
BATCH = 1024


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri("s3:" + rest if scheme == "s3a" else uri)


class Counted(io.RawIOBase):
    """A stream that knows how many bytes were taken from it."""

    def __init__(self, raw):
        self.raw, self.taken = raw, 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.raw.read(len(buffer))
        buffer[:len(data)] = data
        self.taken += len(data)
        return len(data)


def first_lines(fs: pafs.FileSystem, path: str, n: int):
    """(line, compressed bytes read so far) of the first ``n`` lines (all if 0).  Lines end as in Spark's text
    reader: at a line feed, a carriage return or both."""
    with fs.open_input_stream(path, compression=None) as raw:
        taken = Counted(raw)
        stream = gzip.GzipFile(fileobj=taken) if path.endswith(".gz") else io.BufferedReader(taken)
        text = io.TextIOWrapper(stream, encoding="utf-8", errors="replace", newline=None)
        for k, line in enumerate(text):
            yield line.removesuffix("\n"), taken.taken
            if k + 1 == n:
                return


class Files(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class HeadReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.n = options["path"], int(options.get("n", "1000"))
        self.glob, self.limit, self.tasks = options.get("glob", "*.gz"), int(options.get("maxfiles", "0")), int(options.get("tasks", "0"))

    def partitions(self) -> list[InputPartition]:
        """Runs of files by path; names only, as any file source lists them."""
        fs, base = opened(self.root)
        found = fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
        names = sorted(f.path for f in found if f.type == pafs.FileType.File and fnmatch.fnmatch(f.base_name, self.glob) and f.base_name[:1] not in "._")
        names = names[:self.limit] if self.limit > 0 else names
        size = max(1, -(-len(names) // self.tasks)) if self.tasks else 1
        return [Files(names[i:i + size]) for i in range(0, len(names), size)]

    def read(self, partition: Files):
        if partition is None:
            return
        fs, _ = opened(self.root)
        for path in partition.files:
            out = []
            try:
                for k, (line, taken) in enumerate(first_lines(fs, path, self.n)):
                    out.append((k + 1, line, taken))
                    if len(out) == BATCH:
                        yield batch(path, out)
                        out = []
            except (EOFError, OSError) as e:
                raise RuntimeError(f"{path}: {e}") from None
            if out:
                yield batch(path, out)


def batch(path: str, rows: list[tuple]) -> pa.RecordBatch:
    line, value, taken = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), pa.array(line, pa.int32()), pa.array(value), pa.array(taken, pa.int64())], names=["file", "line", "value", "bytes_read"])


class HeadLines(DataSource):
    """``spark.read.format("head_lines").option("n", 1000).load(root)``: file, line (from 1), value and
    bytes_read (compressed bytes of the file read when the line came).  Options: ``n``, ``glob`` (``*.gz``),
    ``maxfiles`` (first files by path; 0: all), ``tasks`` (at most so many partitions; 0: one per file)."""

    @classmethod
    def name(cls) -> str:
        return "head_lines"

    def schema(self) -> str:
        return DDL

    def reader(self, schema) -> HeadReader:
        return HeadReader(dict(self.options))


def heads_of(files: DataFrame, n: int = 1000, path: str = "path", tasks: int | None = None) -> DataFrame:
    """The first ``n`` lines (0: all) of the listed files, which the tasks share evenly: columns as ``head_lines``."""
    def run(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                fs, at = opened(name)
                out = []
                try:
                    for k, (line, taken) in enumerate(first_lines(fs, at, n)):
                        out.append((k + 1, line, taken))
                        if len(out) == BATCH:
                            yield batch(name, out)
                            out = []
                except (EOFError, OSError) as e:
                    raise RuntimeError(f"{name}: {e}") from None
                if out:
                    yield batch(name, out)

    return files.select(path).repartition(tasks or files.sparkSession.sparkContext.defaultParallelism * 4).mapInArrow(run, DDL)


def head_lines(spark: SparkSession, root: str, n: int = 1000, glob: str = "*.gz", max_files: int = 0, tasks: int = 0) -> DataFrame:
    """The first ``n`` lines of each file under ``root``, at any depth: file, line, value, bytes_read
    (null from the text scan).  A missing folder has no lines; a broken file ends the job with its name."""
    base = qualify(spark, root)
    if base.partition(":")[0] in SCHEMES:
        spark.dataSource.register(HeadLines)
        return spark.read.format("head_lines").option("n", n).option("glob", glob).option("maxfiles", max_files).option("tasks", tasks).load(base)
    from ingot.operators.selection import sample_head
    from ingot.sources.listing import list_files
    from ingot.sources.ndjson import read_lines

    names = [r["path"] for r in (list_files(spark, root, glob).orderBy("path").limit(max_files) if max_files > 0 else list_files(spark, root, glob)).select("path").collect()]  # names only
    if not names:
        return spark.createDataFrame([], DDL)
    return sample_head(read_lines(spark, names), n, rank_col="line").select(metadata_path(F.col("file")).alias("file"), "line", "value", F.lit(None).cast("long").alias("bytes_read"))


# readers run on workers that have no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
