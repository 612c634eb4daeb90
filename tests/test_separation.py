"""The library without its optional folders."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_training_data_folders(tmp_path, pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(
        ".git", "__pycache__", "spark-warehouse", ".pytest_cache", "llm", *([] if pipeline else ["corpus_pipeline.py"])
    ))
    code = "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') or q == 'pipeline' for q in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    count, extra = done.stdout.split()
    assert int(count) >= 45 and extra == "False"
