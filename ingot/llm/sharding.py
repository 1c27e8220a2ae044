"""Contiguous shards of equal bytes from global prefix sums.

Rows are range-partitioned in key order and written; each partition's total gives every
partition its offset (the driver holds one row per partition), and running sums inside the
partitions complete the global prefix sums.  A row belongs to the shard in which the middle of
its bytes falls when the whole length is cut at equal targets, so shards are contiguous in key
order and near equal in bytes: off by at most one row at each end.

Law: ``bytes``.  Rows with equal texts are not held together: a group larger than a shard would
break the law.  Defined cases: a null text has size 8 and the crc of an empty text; rows without
a key come first; rows that share a key follow each other by crc and size; an empty table has
no rows.  With fewer rows than shards some shards are empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ingot.llm.common import in_order


def shards(docs: DataFrame, n_shards: int = 24, doc_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(doc_col).alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = in_order(rows, ["doc_id", "text_crc32", "size"], "shard-order")
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).orderBy("part").collect()
    before, offsets, first = 0, [], 0
    for r in totals:
        offsets.append((r["part"], before, first))
        before, first = before + r["bytes"], first + r["rows"]
    offset = docs.sparkSession.createDataFrame(offsets, "part int, before long, first long")  # a row per partition
    w = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = placed.withColumn("sum", F.sum("size").over(w)).join(offset, "part")
    middle = "2 * (before + sum) - size"  # twice the place of the middle of the row's bytes
    cut = running.withColumn("shard", F.expr(f"least({n_shards - 1}, ({middle}) * {n_shards} div {max(1, 2 * before)})").cast("int"))
    cut = cut.withColumn("row", F.col("first") + F.col("nth"))
    begins = cut.groupBy("shard").agg(F.min("row").alias("begin"))  # a row per shard
    return cut.join(begins, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("begin")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 24, doc_col: str = "doc_id", text_col: str = "text") -> None:
    """The documents as Parquet folders ``shard=<k>``, each in key order.  Needs unique keys."""
    own = shards(docs, n_shards, doc_col, text_col).select(F.col("doc_id").alias("_key"), F.col("shard"), F.col("slot").alias("_slot"))
    docs.join(own, docs[doc_col].eqNullSafe(own["_key"])).drop("_key").repartitionByRange("shard", "_slot").sortWithinPartitions("shard", "_slot").drop("_slot").write.partitionBy("shard").parquet(path)
