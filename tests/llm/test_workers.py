"""Workers that have no copy of the package run the operators: code and broadcasts travel by value."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
for q in ("op1_decontamination", "op3_token_shards", "op5_toxicity", "op6_grace_exact_dedup", "op10_url_vocabulary"):
    print(q, entry.queries()[q](s, "/root/testdata/sf0.001").count())
"""


def test_without_the_package_on_the_workers_path(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert len([x for x in out.stdout.splitlines() if x.startswith("op")]) == 5
