"""Incremental intake of a landing prefix (A10 + B6 + K5 as one streaming job).

The file source's checkpoint is the "already done" memory: a rerun with
``availableNow`` picks up only files that arrived since the last run, reading
them straight from the (object-store) path with no copy step.  Each
micro-batch is handed to a ``foreachBatch`` handler that appends table rows
and ledger rows; Spark retries a failed batch, so handlers must be idempotent
per ``batch_id`` (the helpers below overwrite the batch's own partition).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ingot.sources.listing import DATA_GLOB
from ingot.sources.ndjson import line_kind
from ingot.sources.paths import first_component, metadata_path, qualify, relative_to


def stream_lines(spark: SparkSession, root: str, glob: str = DATA_GLOB, max_files_per_trigger: int | None = None,
                 fmt: str = "text") -> DataFrame:
    """Streaming lines with file identity (rel_path, folder) of the files named like ``glob``
    at any depth under ``root``."""
    r = spark.readStream.format(fmt).option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    q = qualify(spark, root)
    df = r.load(root.rstrip("/"))
    rel = relative_to(metadata_path(F.col("_metadata.file_path")), q)
    return df.select("value", metadata_path(F.col("_metadata.file_path")).alias("file"),
                     rel.alias("rel_path"), first_component(rel).alias("folder"))


def stream_intake(spark: SparkSession, root: str, checkpoint: str,
                  handler: Callable[[DataFrame, int], None], available_now: bool = True,
                  glob: str = DATA_GLOB, max_files_per_trigger: int | None = None,
                  query_name: str | None = None) -> StreamingQuery:
    """Start the intake stream; with ``available_now`` it stops after the backlog."""
    lines = stream_lines(spark, root, glob, max_files_per_trigger)
    w = lines.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def ndjson_table_handler(schema: T.StructType, table_path: str, ledger_path: str,
                         run: int = 0) -> Callable[[DataFrame, int], None]:
    """A handler that parses good lines into ``table_path`` and writes one ledger row
    per file to ``ledger_path``, both partitioned by ``run`` and ``batch``.

    Each batch overwrites only its own (run, batch) partition, so a retried
    batch replaces its earlier partial output instead of duplicating it.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        here = [F.lit(run).alias("run"), F.lit(batch_id).cast("bigint").alias("batch")]
        kind = line_kind(F.col("value"))
        good = batch.withColumn("_kind", kind).where("_kind = 'good'")
        recs = (good.select(F.from_json("value", schema).alias("r"), "rel_path", "folder")
                .select("r.*", "rel_path", "folder", *here))
        (recs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run", "batch").parquet(table_path))
        # Counts come from the batch's own files: a file without a good line gets a row too.
        led = (batch.groupBy(F.col("rel_path").alias("file"))
               .agg(F.count_if(kind == "good").alias("records"), F.count_if(kind == "bad").alias("dropped"))
               .select("file", "records", "dropped", F.lit("OK").alias("status"), *here))
        (led.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run", "batch").parquet(ledger_path))
    return handle
