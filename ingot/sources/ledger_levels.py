"""A ledger of very many files (A6, J2, J3, U1): compacted into bucketed runs.

Rows are appended as ever (``append_ledger``).  ``compact`` folds them into runs: one row per file, bucketed
and sorted by file name, all runs of a ledger with the same number of buckets.  A run takes newer ones in
when it is at most ``ratio`` times as large as they are together, so a ledger of n rows has about log n runs
and a row is rewritten about log n times.  ``pending`` deals the items once, by the buckets, and joins them
with each run where it lies: the ledger side has no shuffle, whatever its size.

A row of a run holds the file's last ledger row and ``statuses``, the distinct statuses it ever had, so both forms of
``pending`` (any row; rows of given statuses) and ``latest_status`` have the same results as over all
rows.  What is compacted is known by the names of the part files, not by times, so a row appended meanwhile stays
in the tail.  A compaction is committed by a document whose name must be new; of racing ones a single one
wins and the others' runs are never read.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.session import fs_create_new, fs_delete, fs_names, fs_read_text
from ingot.sources.ledger import LEDGER_DDL, RUN_DDL, ledger_path


def folded(rows: DataFrame) -> DataFrame:
    """One row per file of rows with ``statuses``: the last by batch and time of append, all statuses."""
    rest = [c for c in rows.columns if c not in ("file", "statuses")]
    last = F.struct("batch", F.coalesce("written", F.lit(0)))
    return (rows.groupBy("file")
            .agg(F.max_by(F.struct(*rest), last).alias("_l"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("statuses")))).alias("statuses"))
            .select("file", "_l.*", "statuses"))


class LeveledLedger:
    """The ledger of one (kind, version, dataset) below ``root`` with its runs, which lie in ``<root>-runs``.

    ``buckets`` is fixed by the first compaction; about one per 128 MB that the ledger will have."""

    def __init__(self, spark: SparkSession, root: str, kind: str, version: str, dataset: str, buckets: int = 64):
        self.spark, self.kind = spark, kind
        self.path = ledger_path(root, kind, version, dataset)
        self.home = f"{root.rstrip('/')}-runs/{kind}-{version}-{dataset}"
        self.schema = LEDGER_DDL[kind] + RUN_DDL
        self._buckets = buckets

    def entry(self) -> dict:
        """The newest log document: number, buckets, runs (oldest first), consumed part files."""
        names = [n for n in fs_names(self.spark, f"{self.home}/_log") if n.endswith(".json") and n[:-5].isdigit()]
        if not names:
            return {"number": 0, "buckets": self._buckets, "runs": [], "consumed": []}
        return json.loads(fs_read_text(self.spark, f"{self.home}/_log/{names[-1]}"))

    def _parts(self) -> list[str]:
        return [n for n in fs_names(self.spark, self.path) if n[:1] not in "._"]

    def _rows(self, parts: list[str]) -> DataFrame:
        """Rows of appended part files, in the columns of a run."""
        rows = (self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{n}" for n in parts]) if parts
                else self.spark.createDataFrame([], self.schema))
        return rows.withColumn("statuses", F.array_compact(F.array("status")))

    def _table(self, run: dict, buckets: int) -> DataFrame:
        """A run as a bucketed table; the catalog entry is made anew where this session has none."""
        place = f"{self.home}/{run['id']}".replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS ledger_run_{run['id']} ({self.schema}, statuses array<string>) USING parquet "
                       f"CLUSTERED BY (file) SORTED BY (file) INTO {buckets} BUCKETS LOCATION '{place}'")
        return self.spark.table(f"ledger_run_{run['id']}")

    def tail(self) -> DataFrame:
        """Rows that no run holds yet."""
        done = set(self.entry()["consumed"])
        return self._rows([n for n in self._parts() if n not in done])

    def compact(self, ratio: int = 4) -> int:
        """Folds the tail, and the newest runs it has outgrown, into one run; number of runs after it.  Of
        racing compactions the later one leaves the ledger as the first has made it."""
        e = self.entry()
        done = set(e["consumed"])
        parts = [n for n in self._parts() if n not in done]
        if not parts:
            return len(e["runs"])
        rows, runs = self._rows(parts), list(e["runs"])
        size = rows.count()
        while runs and runs[-1]["rows"] <= ratio * size:
            size += runs[-1]["rows"]
            rows = rows.unionByName(self._table(runs.pop(), e["buckets"]))
        run = {"id": uuid.uuid4().hex}
        (folded(rows).repartition(e["buckets"], "file").write.format("parquet").bucketBy(e["buckets"], "file").sortBy("file")
         .option("path", f"{self.home}/{run['id']}").saveAsTable(f"ledger_run_{run['id']}"))
        run["rows"] = self.spark.table(f"ledger_run_{run['id']}").count()
        new = e | {"number": e["number"] + 1, "runs": [*runs, run], "consumed": [*e["consumed"], *parts], "committed": time.time()}
        if not fs_create_new(self.spark, f"{self.home}/_log/{new['number']:012d}.json", json.dumps(new)):
            self._drop(run["id"])
            return len(self.entry()["runs"])
        return len(new["runs"])

    def pending(self, items: DataFrame, on: str = "file", done_status: tuple[str, ...] | None = None) -> DataFrame:
        """Items without a ledger row (J2), or without a row in ``done_status`` (J3).  The items are dealt once;
        each run is read by its buckets.  A null name is always pending."""
        e = self.entry()
        done = set(e["consumed"])
        parts = [n for n in self._parts() if n not in done]
        counts = F.arrays_overlap("statuses", F.array(*[F.lit(s) for s in done_status])) if done_status else F.lit(True)
        out = items.repartition(e["buckets"], on) if e["runs"] else items
        for run in e["runs"]:
            out = out.join(self._table(run, e["buckets"]).where(counts).select(F.col("file").alias(on)).hint("merge"), on, "left_anti")
        return out.join(self._rows(parts).where(counts).select(F.col("file").alias(on)).distinct(), on, "left_anti") if parts else out

    def latest(self) -> DataFrame:
        """Last row per file over runs and tail: the columns of ``latest_status``."""
        e = self.entry()
        done = set(e["consumed"])
        rows = self._rows([n for n in self._parts() if n not in done])
        for run in e["runs"]:
            rows = rows.unionByName(self._table(run, e["buckets"]))
        return folded(rows).drop("written", "statuses")

    def vacuum(self) -> int:
        """Removes part files that runs hold and runs that are superseded, once no reader of an older state is
        left; number of part files removed.  Appends that run meanwhile are left alone."""
        e = self.entry()
        gone = sorted(set(self._parts()) & set(e["consumed"]))
        for n in gone:
            fs_delete(self.spark, f"{self.path}/{n}")
        held = {r["id"] for r in e["runs"]}
        old = [json.loads(fs_read_text(self.spark, f"{self.home}/_log/{n}")) for n in fs_names(self.spark, f"{self.home}/_log") if n.endswith(".json")]
        for i in {r["id"] for d in old for r in d["runs"]} - held:
            self._drop(i)
        return len(gone)

    def _drop(self, run: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS ledger_run_{run}")
        fs_delete(self.spark, f"{self.home}/{run}")
