"""All tests can be collected from the root, with the training-data folders
and without them."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LEFT_OUT = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", ".hypothesis", "spark-warehouse")


@pytest.mark.parametrize("whole", [True, False])
def test_collects(tmp_path, whole):
    copy = tmp_path / "copy"
    drop = shutil.ignore_patterns("llm", "corpus_pipeline.py")
    shutil.copytree(ROOT, copy, ignore=lambda d, names: LEFT_OUT(d, names) | (set() if whole else drop(d, names)))
    if whole and not (copy / "tests" / "llm").exists():
        pytest.skip("the folders are not there")
    out = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"],
                         cwd=copy, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stdout[-2000:]
    assert "tests/test_oracle.py::test_query_matches_sql_oracle[mart_region_day]" in out.stdout
    assert ("tests/llm/" in out.stdout) == whole
