import gzip
import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ingot.session import get_spark

    s = get_spark("ingot-tests", master="local[2]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    if not (s.sparkContext.getCheckpointDir() or s.conf.get("spark.checkpoint.dir", None)):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ingot-test-ckpt-"))
    yield s


def write_gz(path, lines, newline_at_end=True):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    text = "\n".join(lines) + ("\n" if newline_at_end else "")
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(text)


def jl(*records):
    return [json.dumps(r) for r in records]


@pytest.fixture
def snapshot(tmp_path):
    """``<root>/works/<folder>/<part>.gz``: three folders, two files each, plus a
    manifest and a ``*.tmp`` file that listings must ignore."""
    root = tmp_path / "raw"
    n = 0
    for folder in ("updated_date=2024-01-03", "updated_date=2024-01-01", "updated_date=2024-01-02"):
        for part in ("part_000.gz", "part_001.gz"):
            recs = [{"id": f"W{n + i}", "cited_by_count": i} for i in range(3)]
            n += 3
            write_gz(str(root / "works" / folder / part), jl(*recs))
    (root / "works" / "manifest").write_text("{}")
    (root / "works" / "updated_date=2024-01-01" / "part_002.gz.tmp").write_text("junk")
    return root
