"""Tables with a log of versions (K3) and a load that stops at its bad-record limit.

A table is a folder: ``data/<id>/`` holds what one load wrote, ``_log/<version>.json`` names the data
folders, schema and counts of a version.  A version is committed by creating its log document under
a name that must be new, so of writers that start from the same version one wins and the others get
``PublishConflict``.  Nothing is overwritten: readers of an older version go on reading it until ``expire``
removes it, any version can be read or rolled back to, and schemas may differ between versions.

``staged_load`` writes groups of files in several jobs at a time under one job tag.  The bad
records of finished groups are added up while the others run; above the limit the jobs of the tag are
cancelled, the staged folder is removed and the table stays as it was.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.session import fs_create_new, fs_delete, fs_names, fs_read_text
from ingot.sinks.table import BadRecordLimitExceeded


class PublishConflict(RuntimeError):
    """Another writer committed the version first."""


class TableLog:
    """The versions of the table in the folder ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _name(self, version: int) -> str:
        return f"{self.root}/_log/{version:012d}.json"

    def versions(self) -> list[int]:
        """Versions that can be read, ascending."""
        return [int(n[:-5]) for n in fs_names(self.spark, f"{self.root}/_log") if n.endswith(".json") and n[:-5].isdigit()]

    def latest(self) -> int:
        """The newest version; 0 before the first."""
        return max(self.versions(), default=0)

    def entry(self, version: int | None = None) -> dict:
        """The log document of a version (the newest)."""
        version = self.latest() if version is None else version
        if version not in self.versions():
            raise ValueError(f"{self.root}: no version {version}")
        return json.loads(fs_read_text(self.spark, self._name(version)))

    def history(self) -> DataFrame:
        """One row per version: version, op, of (the version rolled back to), rows, bad, n_folders, committed."""
        rows = [(v, e["op"], e.get("of"), e["rows"], e["bad"], len(e["data"]), e["committed"]) for v in self.versions() for e in [self.entry(v)]]
        return self.spark.createDataFrame(rows, "version bigint, op string, of bigint, rows bigint, bad bigint, n_folders int, committed double")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the newest)."""
        e = self.entry(version)
        schema = T.StructType.fromJson(e["schema"])
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[f"{self.root}/{d}" for d in e["data"]]) if e["data"] else self.spark.createDataFrame([], schema)

    def commit(self, base: int, entry: dict) -> int:
        """Makes ``entry`` version ``base`` + 1, unless that exists."""
        entry = entry | {"committed": time.time()}
        if not fs_create_new(self.spark, self._name(base + 1), json.dumps(entry)):
            raise PublishConflict(f"{self.root}: version {base + 1} was committed by another writer")
        return base + 1

    def rollback(self, version: int) -> int:
        """A new version with the data of an older one."""
        base = self.latest()
        return self.commit(base, self.entry(version) | {"op": "rollback", "of": version})

    def expire(self, keep: int = 2, min_age: float = 0.0) -> list[str]:
        """Removes versions but the newest ``keep``, if they were superseded at least ``min_age`` seconds ago,
        and the data folders that no remaining version names; these are returned.  Folders of loads
        that are not committed are left alone."""
        versions = self.versions()
        entries = {v: self.entry(v) for v in versions}
        now, gone = time.time(), []
        for v, after in zip(versions[:-1], versions[1:]):
            if v > versions[-1] - keep or now - entries[after]["committed"] < min_age:
                break
            gone.append(v)
        held = {d for v in versions if v not in gone for d in entries[v]["data"]}
        folders = sorted({d for v in gone for d in entries[v]["data"]} - held)
        for v in gone:  # first the names, then what they name
            fs_delete(self.spark, self._name(v))
        for d in folders:
            fs_delete(self.spark, f"{self.root}/{d}")
        return folders


def staged_load(spark: SparkSession, groups: Iterable[DataFrame], path: str, max_bad: int = 0, bad: str = "_bad", parallel: int = 4,
                progress: Callable[[dict], None] | None = None) -> dict:
    """Writes the rows of ``groups`` that are not ``bad`` to ``path``, a folder per group, ``parallel`` jobs at a
    time.  After each group ``progress`` gets groups, rows, bad, seconds, rate (rows a second) so far.
    Above ``max_bad`` the running jobs are cancelled, ``path`` is removed and ``BadRecordLimitExceeded``
    raised; its ``groups`` tells how many groups were begun."""
    sc, tag = spark.sparkContext, f"ingot-load-{uuid.uuid4().hex}"
    total, lock, begin = {"groups": 0, "rows": 0, "bad": 0}, threading.Lock(), time.time()
    over = threading.Event()

    def one(k: int, df: DataFrame) -> None:
        if over.is_set():
            return
        sc.addJobTag(tag)
        try:
            seen = Observation(f"load-{uuid.uuid4().hex}")
            rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.col(bad), F.lit(False))).alias("bad"))
            rows.where(~F.coalesce(F.col(bad), F.lit(False))).drop(bad).write.parquet(f"{path}/g{k:08d}")
            got = seen.get
        finally:
            sc.removeJobTag(tag)
        with lock:
            total["groups"] += 1
            total["rows"] += int(got["rows"] or 0) - int(got["bad"] or 0)
            total["bad"] += int(got["bad"] or 0)
            if total["bad"] > max_bad and not over.is_set():
                over.set()
                sc.cancelJobsWithTag(tag)
            seconds = time.time() - begin
            if progress:
                progress(total | {"seconds": seconds, "rate": total["rows"] / max(seconds, 1e-9)})

    running, error, begun = set(), None, 0
    with ThreadPoolExecutor(parallel) as pool:
        for df in groups:
            if over.is_set() or error:
                break
            running.add(pool.submit(one, begun, df))
            begun += 1
            while len(running) >= parallel:
                done, running = wait(running, return_when=FIRST_COMPLETED)
                error = error or next((e for f in done if (e := f.exception())), None)
        error = error or next((e for f in wait(running).done if (e := f.exception())), None)
    if over.is_set() or error:
        fs_delete(spark, path)
    if over.is_set():  # the other groups' errors come from the cancellation
        e = BadRecordLimitExceeded(f"{total['bad']} bad records > limit {max_bad} after {total['groups']} of {begun} groups begun; table not replaced")
        e.groups = begun
        raise e
    if error:
        raise error
    return total | {"seconds": time.time() - begin}


def publish_version(spark: SparkSession, groups: Iterable[DataFrame], root: str, schema: T.StructType, max_bad: int = 0, bad: str = "_bad", append: bool = False,
                    parallel: int = 4, progress: Callable[[dict], None] | None = None, base: int | None = None) -> dict:
    """Loads ``groups`` as a new version of the table at ``root``: version, rows, bad, seconds.  The version is the
    one after ``base`` (the newest as the load begins); if another writer took it meanwhile, a
    replacing load is removed and raises ``PublishConflict``, an appending one goes after it."""
    log = TableLog(spark, root)
    base = log.latest() if base is None else base
    folder = f"data/{uuid.uuid4().hex}"
    got = staged_load(spark, groups, f"{log.root}/{folder}", max_bad, bad, parallel, progress)
    own = [folder] if got["groups"] else []
    while True:
        old = log.entry(base) if append and base else {"data": [], "rows": 0, "bad": 0}
        if append and base and old["schema"] != schema.jsonValue():
            fs_delete(spark, f"{log.root}/{folder}")
            raise ValueError(f"{root}: rows to append have another schema")
        entry = {"op": "append" if append else "replace", "data": old["data"] + own, "rows": old["rows"] + got["rows"], "bad": old["bad"] + got["bad"], "schema": schema.jsonValue()}
        try:
            return got | {"version": log.commit(base, entry)}
        except PublishConflict:
            if not append:
                fs_delete(spark, f"{log.root}/{folder}")
                raise
            base = log.latest()
