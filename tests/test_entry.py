"""The entry module works without the optional subpackage, whatever is left of it."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = ("import __spark_entry__ as e; from sparkops.plans.queries import QUERIES; "
        "assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql()), set(e.queries()) ^ set(QUERIES); print('fine')")


@pytest.mark.parametrize("left", ["nothing", "empty folder", "pipeline too"])
def test_entry_without_the_optional_operators(tmp_path, left):
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(ROOT, "sparkops"), copy / "sparkops", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), copy)
    if left == "empty folder":
        (copy / "sparkops" / "llm").mkdir()
    pipeline = os.path.join(ROOT, "corpus_pipeline.py")
    if left == "pipeline too" and os.path.exists(pipeline):
        shutil.copy(pipeline, copy)
    done = subprocess.run([sys.executable, "-c", SAYS], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert done.stdout.strip() == "fine", done.stderr[-800:]
