"""Continuous validation (A10, G4): the verdict of a dataset as soon as it is known, while files arrive.

Manifest entries and file counts come as one stream of rows, in any order and over any number of batches.
For each dataset the state holds the expected and counted number of each file (a map, one entry per file)
and running totals, so a batch costs as much as it has rows, whatever the size of the dataset.  A row goes
out whenever a dataset's verdict changes: PASS when every entry is counted as expected and the sum is the
manifest's total, FAIL when every entry is counted and a file or the total is off.  A timer, ``patience``
after the manifest and after each of its reports, tells for an unfinished dataset what is missing:
one row MISSING per entry that no count has come for.

Counts of files that no entry names (yet) wait in the state.  A file counted again, or an entry told again,
replaces itself; so a repeated batch changes nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Rows in: an entry has ``expected`` and the manifest's ``total`` and number of ``entries``, a count ``actual``.
EVENT_DDL = "dataset string, file string, expected bigint, actual bigint, total bigint, entries bigint"
VERDICT_DDL = "dataset string, verdict string, file string, expected bigint, actual bigint, n_missing bigint, n_mismatch bigint"
SUMS = ("total", "entries", "n_entries", "n_counted", "n_ok", "actual")
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class DatasetVerdict(StatefulProcessor):
    """State of one dataset; ``patience`` in milliseconds, 0 for no reports."""

    def __init__(self, patience: int):
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.files = handle.getMapState("files", "file string", "expected bigint, actual bigint")
        self.sums = handle.getValueState("sums", ", ".join(f"{c} bigint" for c in SUMS) + ", verdict string")

    def read(self) -> dict:
        return dict(zip((*SUMS, "verdict"), self.sums.get())) if self.sums.exists() else dict.fromkeys(SUMS, 0) | {"total": None, "entries": None, "verdict": ""}

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        s = self.read()
        known = s["entries"] is not None
        for r in rows:
            if r.entries is not None:
                s["total"], s["entries"] = r.total, r.entries
            if r.file is None:  # the manifest's own row
                continue
            expected, actual = self.files.getValue((r.file,)) if self.files.containsKey((r.file,)) else (None, None)
            for sign in (-1, 1):  # the file leaves the sums as it was and enters them as it is
                if expected is not None:
                    s["n_entries"] += sign
                    s["n_counted"] += sign * (actual is not None)
                    s["n_ok"] += sign * (actual == expected)
                    s["actual"] += sign * (actual or 0)
                if sign < 0:
                    expected = r.expected if r.expected is not None else expected
                    actual = r.actual if r.actual is not None else actual
            self.files.updateValue((r.file,), (expected, actual))
        verdict = ""
        if s["entries"] is not None and s["n_entries"] == s["entries"] == s["n_counted"]:
            verdict = "PASS" if s["n_ok"] == s["entries"] and s["actual"] == s["total"] else "FAIL"
        told = verdict and verdict != s["verdict"]
        s["verdict"] = verdict
        self.sums.update(tuple(s.values()))
        if self.patience and s["entries"] is not None and not known and not verdict:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience)
        if told:
            yield Row(dataset=key[0], verdict=verdict, file=None, expected=s["total"], actual=s["actual"], n_missing=0, n_mismatch=s["entries"] - s["n_ok"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        s = self.read()
        if s["verdict"]:
            return
        missing = s["entries"] - s["n_counted"]
        for (name,), (expected, actual) in self.files.iterator():
            if expected is not None and actual is None:
                yield Row(dataset=key[0], verdict="MISSING", file=name, expected=expected, actual=None, n_missing=missing, n_mismatch=s["n_counted"] - s["n_ok"])
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience)

    def close(self) -> None:
        pass


def continuous_verdict(events: DataFrame, patience: int = 0) -> DataFrame:
    """Verdicts (``VERDICT_DDL``) of a stream of ``EVENT_DDL`` rows."""
    return events.groupBy("dataset").transformWithState(DatasetVerdict(patience), VERDICT_DDL, "Append", "ProcessingTime")


def manifest_events(entries: DataFrame) -> DataFrame:
    """Events of manifest entries (dataset, rel_path, expected, total): one per entry and one per manifest."""
    own = entries.groupBy("dataset").agg(F.max("total").alias("total"), F.count("rel_path").alias("entries"))
    none = F.lit(None).cast("bigint")
    rows = entries.where("rel_path is not null").select("dataset", F.col("rel_path").alias("file"), "expected", none.alias("actual"), none.alias("total"), none.alias("entries"))
    return rows.unionByName(own.select("dataset", F.lit(None).cast("string").alias("file"), none.alias("expected"), none.alias("actual"), "total", "entries"))


def count_events(counts: DataFrame) -> DataFrame:
    """Events of counted files (dataset, rel_path, actual)."""
    none = F.lit(None).cast("bigint")
    return counts.select("dataset", F.col("rel_path").alias("file"), none.alias("expected"), "actual", none.alias("total"), none.alias("entries"))


def run_verdicts(events_path: str, out_path: str, checkpoint: str, spark, patience: int = 0, available_now: bool = True):
    """Reads event files (Parquet) as they arrive under ``events_path``, appends verdicts to ``out_path``; with
    ``available_now`` it stops after the backlog."""
    from ingot.plans.groups import setting

    # with processing time Spark would run batches without data for ever; a backlog run has an end
    with setting(spark, "spark.sql.streaming.stateStore.providerClass", PROVIDER), setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", str(not available_now).lower()):
        events = spark.readStream.schema(EVENT_DDL).option("recursiveFileLookup", "true").parquet(events_path)
        w = continuous_verdict(events, patience).writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append")
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


# the processor runs on workers that have no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
