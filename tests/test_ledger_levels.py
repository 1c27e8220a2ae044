"""A ledger in runs and a tail has the results of the plain one, without a shuffle of its rows."""

import random
import re

from pyspark.sql import functions as F

from ingot.operators.selection import pending
from ingot.sources.ledger import append_ledger, latest_status, read_ledger
from ingot.sources.ledger_levels import LeveledLedger

AT = ("upload", "v1", "works")


def _append(spark, root, rows, batch):
    append_ledger(spark.createDataFrame(rows, "file string, destination string, status string"), root, *AT, batch=batch)


def _same(spark, root, ledger, items):
    plain = read_ledger(spark, root, *AT)
    for status in (None, ("OK",), ("FAIL", "LOST")):
        want = sorted(map(str, pending(items, plain, "file", status).collect()))
        assert sorted(map(str, ledger.pending(items, "file", status).collect())) == want
    cols = latest_status(plain).columns
    assert sorted(map(str, ledger.latest().select(cols).collect())) == sorted(map(str, latest_status(plain).collect()))


def test_runs_and_tail_equal_the_plain_ledger(spark, tmp_path):
    root, draw = str(tmp_path / "ledger"), random.Random(5)
    ledger = LeveledLedger(spark, root, *AT, buckets=4)
    items = spark.createDataFrame([(f"f{i}", i) for i in range(60)] + [(None, -1), ("f1", 99)], "file string, extra int")
    assert ledger.pending(items).count() == 62 and ledger.latest().count() == 0 and ledger.compact() == 0
    for batch, size in enumerate((40, 3, 1, 30, 0, 2)):
        rows = [(f"f{draw.randrange(50)}", f"d{batch}", draw.choice(["OK", "FAIL", None])) for _ in range(size)]
        _append(spark, root, [*rows, *rows[:1]], batch)  # a repeated row too
        _same(spark, root, ledger, items)  # rows in the tail
        ledger.compact(ratio=2)
        assert ledger.tail().count() == 0
        _same(spark, root, ledger, items)
    assert 1 <= len(ledger.entry()["runs"]) <= 3


def test_ledger_side_has_no_exchange(spark, tmp_path):
    root = str(tmp_path / "ledger")
    ledger = LeveledLedger(spark, root, *AT, buckets=4)
    for batch, size in enumerate((50, 2)):
        _append(spark, root, [(f"f{batch}-{i}", "d", "OK") for i in range(size)], batch)
        ledger.compact(ratio=1)
    assert len(ledger.entry()["runs"]) == 2
    items = spark.range(100).select(F.concat(F.lit("f0-"), "id").alias("file"))
    left = ledger.pending(items, done_status=("OK",))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange\b", plan)) == 1 and "BroadcastExchange" not in plan and plan.count("Bucketed: true") == 2
    assert left.count() == 50


def test_race_vacuum_and_a_session_without_the_tables(spark, tmp_path):
    root = str(tmp_path / "ledger")
    ledger, other = (LeveledLedger(spark, root, *AT, buckets=4) for _ in range(2))
    _append(spark, root, [("a", "d", "OK"), ("b", "d", "FAIL")], 0)
    stale = other.entry()
    ledger.compact()
    other.entry = lambda e=iter([stale]): next(e, None) or LeveledLedger.entry(other)
    assert other.compact() == 1 and ledger.entry()["number"] == 1  # the racing one changes nothing
    _append(spark, root, [("b", "d", "OK")], 1)
    ledger.compact()
    assert ledger.vacuum() > 0 and ledger.vacuum() == 0
    for r in ledger.entry()["runs"]:
        spark.sql(f"DROP TABLE ledger_run_{r['id']}")  # external: the files stay
    again = LeveledLedger(spark, root, *AT, buckets=9)  # the buckets of the first compaction hold
    assert {r.file: (r.status, r.batch) for r in again.latest().collect()} == {"a": ("OK", 0), "b": ("OK", 1)}
    assert [r.file for r in again.pending(spark.createDataFrame([("a",), ("c",)], "file string")).collect()] == ["c"]
