import pytest

from ingot.streaming.verdict import EVENT_DDL, VERDICT_DDL, count_events, manifest_events, run_verdicts


@pytest.fixture
def feed(spark, tmp_path):
    seen = []

    def step(*events, patience=0):
        spark.createDataFrame(list(events), EVENT_DDL).repartition(2).write.mode("append").parquet(str(tmp_path / "events"))
        run_verdicts(str(tmp_path / "events"), str(tmp_path / "out"), str(tmp_path / "ckpt"), spark, patience).awaitTermination()
        rows = [tuple(r) for r in spark.read.schema(VERDICT_DDL).parquet(str(tmp_path / "out")).collect()]
        new = list(rows)
        for r in seen:
            new.remove(r)
        seen.extend(new)
        return sorted(new, key=str)

    return step


def test_verdicts_come_when_they_are_known(feed):
    entry = lambda d, f, n: (d, f, n, None, None, None)
    count = lambda d, f, n: (d, f, None, n, None, None)
    whole = lambda d, total, k: (d, None, None, None, total, k)
    # counts may come before their manifest; b is complete at once, c has a wrong total, d is an empty manifest
    assert feed(count("a", "1", 5), entry("b", "1", 2), count("b", "1", 2), whole("b", 2, 1), entry("c", "1", 1), count("c", "1", 1), whole("c", 9, 1), whole("d", 0, 0), patience=1) == [
        ("b", "PASS", None, 2, 2, 0, 0), ("c", "FAIL", None, 9, 1, 0, 0), ("d", "PASS", None, 0, 0, 0, 0)]
    assert feed(whole("a", 8, 3), entry("a", "1", 5), entry("a", "2", 1), entry("a", "3", 2), count("a", "9", 99), patience=1) == []
    # the timer tells what is missing, once a file more has come
    assert feed(count("a", "2", 7), patience=1) == [("a", "MISSING", "3", 2, None, 1, 1)]
    assert [r[:3] for r in feed(count("a", "3", 2), patience=1)] == [("a", "FAIL", None)]
    # the file is counted again, a batch is repeated; c's manifest is corrected
    assert feed(count("a", "2", 1), whole("c", 1, 1), count("b", "1", 2), patience=1) == [("a", "PASS", None, 8, 8, 0, 0), ("c", "PASS", None, 1, 1, 0, 0)]


def test_events(spark):
    m = spark.createDataFrame([("a", "x", 1, 3), ("a", "y", 2, 3), ("e", None, None, 0)], "dataset string, rel_path string, expected bigint, total bigint")
    assert sorted(manifest_events(m).collect(), key=str) == sorted([("a", "x", 1, None, None, None), ("a", "y", 2, None, None, None), ("a", None, None, None, 3, 2), ("e", None, None, None, 0, 0)], key=str)
    c = spark.createDataFrame([("a", "x", 1)], "dataset string, rel_path string, actual bigint")
    assert [tuple(r) for r in count_events(c).collect()] == [("a", "x", None, 1, None, None)]
