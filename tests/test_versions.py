import os
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.plans.load import load_version
from ingot.session import fs_create_new, fs_read_text
from ingot.sinks.table import BadRecordLimitExceeded
from ingot.sinks.versions import PublishConflict, TableLog, publish_version, staged_load
from tests.conftest import jl, write_gz

K = T.StructType([T.StructField("k", T.LongType())])


def part(spark, a, b, bad="false"):
    return spark.range(a, b).toDF("k").withColumn("_bad", F.expr(bad))


def test_versions_stay_readable(spark, tmp_path):
    root = str(tmp_path / "t")
    log = TableLog(spark, root)
    assert log.latest() == 0 and log.history().collect() == []
    publish_version(spark, [part(spark, 0, 5)], root, K)
    old = log.read()
    publish_version(spark, [part(spark, 0, 3), part(spark, 3, 9, "k = 4")], root, K, max_bad=1)
    assert old.count() == 5 and log.read().count() == 8 and log.read(1).count() == 5
    wide = T.StructType([*K.fields, T.StructField("s", T.StringType())])  # another schema needs no drop
    publish_version(spark, [part(spark, 0, 2).withColumn("s", F.lit("x"))], root, wide)
    assert log.read().columns == ["k", "s"] and log.read(2).columns == ["k"]
    assert log.rollback(1) == 4 and log.read().count() == 5
    assert [(r.version, r.op, r.of, r.rows, r.bad) for r in log.history().collect()] == [(1, "replace", None, 5, 0), (2, "replace", None, 8, 1), (3, "replace", None, 2, 0), (4, "rollback", 1, 5, 0)]
    publish_version(spark, [part(spark, 100, 103)], root, K, append=True)
    assert log.read().count() == 8 and log.entry()["rows"] == 8
    assert log.expire(keep=1, min_age=3600) == [] and log.versions() == [1, 2, 3, 4, 5]
    gone = log.expire(keep=2)  # versions 1 to 3; the data of 1 is still named by 4
    assert len(gone) == 2 and log.versions() == [4, 5] and old.count() == 5 and len(os.listdir(f"{root}/data")) == 2
    with pytest.raises(ValueError, match="no version 2"):
        log.read(2)
    with pytest.raises(ValueError, match="another schema"):
        publish_version(spark, [part(spark, 0, 2).withColumn("s", F.lit("x"))], root, wide, append=True)
    publish_version(spark, [], root, K)
    assert log.read().collect() == [] and log.read().columns == ["k"]


def test_one_of_racing_writers_wins(spark, tmp_path):
    root = str(tmp_path / "t")
    publish_version(spark, [part(spark, 0, 5)], root, K)
    outcomes, start = [], threading.Barrier(4)

    def write(n):
        start.wait()
        try:
            outcomes.append((n, publish_version(spark, [part(spark, 0, n)], root, K, base=1)["version"]))
        except PublishConflict:
            outcomes.append((n, None))

    threads = [threading.Thread(target=write, args=(n,)) for n in (11, 12, 13, 14)]
    [t.start() for t in threads], [t.join() for t in threads]
    won = [n for n, v in outcomes if v == 2]
    log = TableLog(spark, root)
    assert len(outcomes) == 4 and len(won) == 1 and log.read().count() == won[0] and len(os.listdir(f"{root}/data")) == 2
    # appends do not exclude each other
    threads = [threading.Thread(target=lambda: publish_version(spark, [part(spark, 0, 7)], root, K, append=True, base=2)) for _ in range(3)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert log.read().count() == won[0] + 21 and log.latest() == 5
    name = str(tmp_path / "doc")
    assert fs_create_new(spark, name, "one") and not fs_create_new(spark, name, "two") and fs_read_text(spark, name) == "one" and [n for n in os.listdir(tmp_path) if n.startswith(".")] in ([], [".doc.crc"])


def test_a_load_over_its_limit_stops_early(spark, tmp_path):
    root, schema = str(tmp_path / "t"), T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])
    for k in range(40):
        write_gz(str(tmp_path / "data" / "works" / "f" / f"p{k:02d}.gz"), jl(*[{"id": f"{k}", "n": i} for i in range(20)]) + (['{"id": 1, "zz": 2}', "junk"] if k in (1, 2) else []))
    args = (spark, "works", "v1", str(tmp_path / "data"), schema, root)
    seen = []
    got = load_version(*args, max_bad=4, group_files=4, progress=seen.append)
    log = TableLog(spark, f"{root}/works_v1")
    assert (got["version"], got["rows"], got["bad"], got["groups"]) == (1, 800, 4, 10) and log.read().count() == 800
    assert [s["groups"] for s in seen] == list(range(1, 11)) and seen[-1]["rows"] == 800 and all(s["rate"] > 0 for s in seen)
    with pytest.raises(BadRecordLimitExceeded) as e:
        load_version(*args, max_bad=3, group_files=2, parallel=2)
    assert e.value.groups < 20 and log.latest() == 1 and log.read().count() == 800 and len(os.listdir(f"{root}/works_v1/data")) == 1


def test_running_jobs_are_cancelled(spark, tmp_path):
    @F.pandas_udf("long")
    def wait(s):
        time.sleep(60)
        return s

    slow = spark.range(1).select(wait("id").alias("k"), F.lit(False).alias("_bad"))
    begin = time.time()
    with pytest.raises(BadRecordLimitExceeded):
        staged_load(spark, [slow, part(spark, 0, 9, "k = 2")], str(tmp_path / "s"), parallel=2)
    assert time.time() - begin < 40 and not os.path.exists(tmp_path / "s")
    with pytest.raises(Exception, match="boom"):  # other errors pass through
        staged_load(spark, [part(spark, 0, 3).withColumn("k", F.expr("raise_error('boom')"))], str(tmp_path / "s"))
    assert not os.path.exists(tmp_path / "s")
