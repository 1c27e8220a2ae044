"""A profile that follows its files (H4, U2): facts are stored per file and added or retracted as files
come and go.

A schema file knows types only, so merging into it can add and widen but never take back what a
withdrawn or corrected file brought.  Here each run scans only files that are new or whose length or
time changed, and writes three small tables: the facts (path, kind, repeated, n) of each scanned file,
the files that came and went, and the run's change of the totals.  Facts are counts, so the profile is
the sum of all changes; a kind whose count falls to zero is gone.  Totals are schema-sized, whatever
the number of files.

A run is committed by its document in ``_runs``, whose name must be new: what a failed or losing run
wrote is never read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.operators.profile import FACT_DDL, OPEN_MAPS, json_facts, merge_facts
from ingot.session import fs_create_new, fs_names, fs_read_text
from ingot.sources.heads import heads_of

FILE_DDL = "file string, length bigint, modified timestamp, run bigint, present boolean"


class StateConflict(RuntimeError):
    """Another update committed this run first."""


class ProfileState:
    """The stored state in the folder ``root``.  ``sample`` lines of each file are profiled (0: all); it must be the
    same in all runs."""

    def __init__(self, spark: SparkSession, root: str, sample: int = 1000, opaque: tuple[str, ...] = OPEN_MAPS):
        self.spark, self.root, self.sample, self.opaque = spark, root.rstrip("/"), sample, opaque

    def runs(self) -> list[dict]:
        """The committed runs in order (a document each)."""
        names = [n for n in fs_names(self.spark, f"{self.root}/_runs") if n.endswith(".json") and not n.startswith(".")]
        return [json.loads(fs_read_text(self.spark, f"{self.root}/_runs/{n}")) for n in names]

    def _read(self, kind: str, ddl: str, runs: list[dict]) -> DataFrame:
        paths = [f"{self.root}/{r['folder']}/{kind}" for r in runs]
        return self.spark.read.schema(ddl).parquet(*paths) if paths else self.spark.createDataFrame([], ddl)

    def files(self) -> DataFrame:
        """The files the profile stands for: file, length, modified, run (that scanned them)."""
        rows = self._read("files", FILE_DDL, self.runs())
        # a file's withdrawal has the run of its scan, so each (file, run) is present unless withdrawn
        return rows.groupBy("file", "run").agg(F.first("length").alias("length"), F.first("modified").alias("modified"), F.bool_and("present").alias("present")).where("present").drop("present")

    def totals(self) -> DataFrame:
        """Facts of all present files: path, kind, repeated, n."""
        return self._read("totals", FACT_DDL, self.runs()).groupBy("path", "kind", "repeated").agg(F.sum("n").alias("n")).where("n > 0")

    def profile(self) -> DataFrame:
        """path, type, mode, n: equal to a profile of all present files from scratch."""
        return merge_facts(self.totals())

    def update(self, files: DataFrame) -> dict:
        """Makes the state that of ``files`` (a whole listing: path, length, modified).  Returns the run and how
        many files were scanned and withdrawn; unchanged files are not opened."""
        runs = self.runs()
        run, folder = len(runs), f"run={len(runs)}-{uuid.uuid4().hex[:8]}"
        now = files.select(F.col("path").alias("file"), "length", "modified")
        known, key = self.files(), ["file", "length", "modified"]
        new, gone = now.join(known, key, "left_anti"), known.join(now, key, "left_anti")
        came = new.select(*key, F.lit(run).cast("bigint").alias("run"), F.lit(True).alias("present"))
        went = gone.select(*key, "run", F.lit(False).alias("present"))
        at = f"{self.root}/{folder}"
        came.unionByName(went).write.parquet(f"{at}/files")
        moved = self.spark.read.schema(FILE_DDL).parquet(f"{at}/files")
        lines = heads_of(moved.where("present"), self.sample, "file")
        json_facts(lines, by=("file",), opaque=self.opaque).write.parquet(f"{at}/facts")
        ddl = f"file string, {FACT_DDL}"
        added = self.spark.read.schema(ddl).parquet(f"{at}/facts")
        old = moved.where("not present").select("file", "run")
        held = [r["run"] for r in old.select("run").distinct().collect()]  # runs, not files
        stored = None
        for r in (runs[k] for k in held):
            part = self._read("facts", ddl, [r]).withColumn("run", F.lit(r["run"]).cast("bigint"))
            stored = part if stored is None else stored.unionByName(part)
        change = added.select("path", "kind", "repeated", "n")
        if stored is not None:
            taken = stored.join(old, ["file", "run"], "left_semi")
            change = change.unionByName(taken.select("path", "kind", "repeated", (-F.col("n")).alias("n")))
        change.groupBy("path", "kind", "repeated").agg(F.sum("n").alias("n")).where("n <> 0").write.parquet(f"{at}/totals")
        n = moved.agg(F.count_if(F.col("present")), F.count_if(~F.col("present"))).first()
        entry = {"run": run, "folder": folder, "scanned": n[0], "withdrawn": n[1]}
        if not fs_create_new(self.spark, f"{self.root}/_runs/{run:08d}.json", json.dumps(entry)):
            raise StateConflict(f"{self.root}: run {run} was committed by another update")
        return entry
