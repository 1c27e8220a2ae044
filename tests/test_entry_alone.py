"""The entry imports without the training-data operators, and without the pipeline."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("gone", [("ingot/llm", "tests/llm"), ("ingot/llm", "tests/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_entry_without(tmp_path, gone):
    copy = tmp_path / "repo"
    leave = {os.path.join(REPO, g) for g in gone}
    shutil.copytree(REPO, copy, ignore=lambda d, names: [n for n in names if os.path.join(d, n) in leave or n in (".git", "__pycache__", ".pytest_cache")])
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), 'pipeline' in q, any(k.startswith('op1_') for k in q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    n, pipeline, op1 = out.stdout.split()
    assert int(n) > 50 and pipeline == "False" and op1 == str("ingot/llm" not in gone)
