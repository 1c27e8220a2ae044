"""Sorted files of lineitem: columns are shuffled and compared, not lines."""

import gzip

from ingot.plans import standins_files


def test_flag_files_are_sorted_by_columns(spark, tmp_path, monkeypatch):
    rows = [("R", k, n) for k in (12, 7, 4999, 5000, 9) for n in (3, 1, 2)] + [(None, 8, 1), ("A", None, 1)]
    li = spark.createDataFrame(rows, "l_returnflag string, l_orderkey long, l_linenumber int")
    plans, write = [], standins_files.write_lines

    def kept(df, *a, **k):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, *a, **k)

    monkeypatch.setattr(standins_files, "write_lines", kept)
    standins_files._flag_files(li, str(tmp_path / "x"), "l_orderkey", "l_linenumber")
    above, _, below = plans[0].partition("Sort [")
    assert "json" in above.lower() and "json" not in below.lower()
    found = [p for p in (tmp_path / "x" / "flag=R" / "bucket=0").iterdir() if p.name.endswith(".gz")]
    with gzip.open(found[0], "rt") as f:
        lines = f.read().splitlines()
    assert len(found) == 1 and lines == [f'{{"l_returnflag":"R","l_orderkey":{k},"l_linenumber":{n}}}' for k in (7, 9, 12, 4999) for n in (1, 2, 3)]
    assert sorted(p.name for p in (tmp_path / "x").iterdir() if p.is_dir()) == ["flag=A", "flag=R", "flag=none"]
