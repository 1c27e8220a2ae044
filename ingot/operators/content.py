"""Content validation (J1, G2, G3): fingerprints that see replaced lines.

A count cannot tell a file from another with as many lines.  The fingerprint of a file is the number of its
lines and two sums, modulo 2**64, of hashes of its lines: a multiset hash.  It does not depend on the order
of lines or on how a file is split, and is additive, so that of a dataset is the sum of those of its files.
One aggregate per file; a hot file is combined in the tasks that read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.functions.jsonf import is_blank
from ingot.session import fs_delete, scratch_dir
from ingot.sources.ledger import append_ledger, latest_status, read_ledger
from ingot.sources.listing import DATA_GLOB, list_files
from ingot.sources.ndjson import raw_lines, with_names



def _folded(total):
    """A sum modulo 2**64, as decimal digits."""
    return (total.cast("decimal(38,0)") % F.lit(str(1 << 64)).cast("decimal(38,0)")).cast("decimal(20,0)").cast("string")


def _halves(value):
    """Upper and lower half of two hashes, as longs whose sums cannot overflow below 2**31 lines a group."""
    for k, h in ((1, F.xxhash64(value)), (2, F.xxhash64(F.lit("content"), F.octet_length(value), value))):
        yield f"_h{k}", F.shiftrightunsigned(h, 32)
        yield f"_l{k}", h.bitwiseAND(0xFFFFFFFF)


def fingerprints(lines: DataFrame, by: str | list[str] = "rel_path", value_col: str = "value") -> DataFrame:
    """Per group of lines (a file): records, f1, f2 (decimal digits).  Blank lines do not count."""
    keys = [by] if isinstance(by, str) else list(by)
    halves = dict(_halves(F.col(value_col)))
    g = lines.where(~is_blank(F.col(value_col))).select(*keys, *[c.alias(n) for n, c in halves.items()]).groupBy(*keys)
    wide = g.agg(F.count(F.lit(1)).alias("records"), *[F.sum(n).cast("decimal(28,0)").alias(n) for n in halves])
    return wide.select(*keys, "records", *[_folded(F.col(f"_h{k}") * F.lit(1 << 32).cast("decimal(10,0)") + F.col(f"_l{k}")).alias(f"f{k}") for k in (1, 2)])


def combined(prints: DataFrame, by: str | list[str] = ()) -> DataFrame:
    """Fingerprints of groups of files from those of the files."""
    keys = [by] if isinstance(by, str) else list(by)
    return prints.groupBy(*keys).agg(F.sum("records").cast("bigint").alias("records"), *[_folded(F.sum(F.col(f).cast("decimal(20,0)"))).alias(f) for f in ("f1", "f2")])


def compare(old: DataFrame, new: DataFrame, by: str = "file") -> DataFrame:
    """Per file: status SAME, CONTENT (as many lines, others), COUNT, ADDED or REMOVED; old and new records; ``was``: for
    an added file the removed one with the same lines, if there is one (the first by name)."""
    j = old.select(by, F.struct("records", "f1", "f2").alias("o")).join(new.select(by, F.struct("records", "f1", "f2").alias("n")), by, "full")
    status = (F.when(F.col("o").isNull(), "ADDED").when(F.col("n").isNull(), "REMOVED").when(F.col("o") == F.col("n"), "SAME")
              .when(F.col("o.records") == F.col("n.records"), "CONTENT").otherwise("COUNT"))
    j = j.select(by, status.alias("status"), F.col("o.records").alias("old_records"), F.col("n.records").alias("new_records"), F.coalesce("n", "o").alias("p"))
    gone = j.where("status = 'REMOVED'").groupBy("p").agg(F.min(by).alias("was"))
    added = j.where("status = 'ADDED'").join(gone, "p", "left").select(by, "was")
    return j.drop("p").join(added, by, "left")


def validate_content(spark: SparkSession, dataset: str, version: str, data_root: str, ledger_root: str, batch_id: int = 0) -> DataFrame:
    """Fingerprints of the dataset's files, compared with those of the run before (ledger kind ``content``) and
    appended to the ledger: file, status, old_records, new_records, was.  The first run adds all files."""
    root = f"{data_root.rstrip('/')}/{dataset}"
    files = list_files(spark, root, DATA_GLOB).select(F.col("rel_path").alias("file"))
    counted = with_names(fingerprints(raw_lines(spark, root, DATA_GLOB), "raw_path"), spark, root).select(F.col("rel_path").alias("file"), "records", "f1", "f2")
    new = files.join(counted, "file", "left").select("file", F.coalesce("records", F.lit(0).cast("bigint")).alias("records"), *[F.coalesce(f, F.lit("0")).alias(f) for f in ("f1", "f2")])
    # a row per file, used several times below: the lines are read once
    path = scratch_dir(spark, "content-files")
    new.write.parquet(path)
    new = spark.read.schema(new.schema).parquet(path)
    before = latest_status(read_ledger(spark, ledger_root, "content", version, dataset)).where("status <> 'REMOVED'")
    # this run's rows first: what is compared is what the ledger holds
    found = compare(before, new)
    append_ledger(found.join(new, "file", "left").select("file", "records", "f1", "f2", "status"), ledger_root, "content", version, dataset, batch_id)
    fs_delete(spark, path)
    rows = read_ledger(spark, ledger_root, "content", version, dataset)
    last = rows.agg(F.max("written")).first()[0]
    before = latest_status(rows.where(F.col("written") < F.lit(last))).where("status <> 'REMOVED'")
    return compare(before, rows.where((F.col("written") == F.lit(last)) & (F.col("status") != "REMOVED")))
