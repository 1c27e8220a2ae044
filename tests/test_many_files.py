"""Many files: lines are read once, and listings do not start a task for each folder."""

import os

from ingot.operators import content
from ingot.session import few_listers
from ingot.sources.listing import DATA_GLOB
from ingot.sources.ndjson import raw_lines
from tests.conftest import jl, write_gz

LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def test_listings_deal_folders_to_few_tasks(spark, tmp_path):
    before = spark.conf.get(LISTERS, None)
    with few_listers(spark):
        assert int(spark.conf.get(LISTERS)) == 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(LISTERS, None) == before
    for k in range(60):
        write_gz(str(tmp_path / f"file={k}" / "a.gz"), jl({"k": k}))
    sc = spark.sparkContext
    sc.setJobGroup("listing", "listing")
    lines = raw_lines(spark, str(tmp_path), DATA_GLOB)
    jobs = sc.statusTracker().getJobIdsForGroup(None)
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    sizes = [tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s) and "isting" in tracker.getStageInfo(s).name]
    assert lines.count() == 60 and 60 not in sizes


def test_content_validation_reads_lines_once(spark, tmp_path, monkeypatch):
    for k in range(4):
        write_gz(str(tmp_path / "data" / "ds" / f"file={k}" / "a.gz"), jl({"k": k}, {"k": -k}))
    seen, plain = str(tmp_path / "seen"), content.raw_lines

    def watched(*a):
        def run(batches):
            for b in batches:
                with open(seen, "a") as f:
                    f.write("x" * b.num_rows)
                yield b

        df = plain(*a)
        return df.mapInArrow(run, df.schema)

    monkeypatch.setattr(content, "raw_lines", watched)
    args = (spark, "ds", "v1", str(tmp_path / "data"), str(tmp_path / "ledger"))
    assert content.validate_content(*args).where("status = 'ADDED' and new_records = 2").count() == 4
    assert os.path.getsize(seen) == 8
    assert content.validate_content(*args, batch_id=1).where("status = 'SAME'").count() == 4
    assert os.path.getsize(seen) == 16
