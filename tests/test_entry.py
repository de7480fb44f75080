"""The entry point with and without the corpus operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CHECK = """
import __spark_entry__ as entry
names = set(entry.queries())
assert "daily_summary" in names and set(entry.oracle_sql()) <= names, names
assert not any(n == "pipeline" or n.startswith("op") and "_" in n and n[2].isdigit() for n in names), names
"""


@pytest.mark.parametrize("left", ["nothing", "empty folder", "pipeline"])
def test_entry_without_corpus_operators(tmp_path, left):
    def skip(folder, names):
        inside = os.path.relpath(folder, ROOT)
        return [n for n in names if n in (".git", "__pycache__", ".pytest_cache") or n == "llm" and inside in ("airloom", "tests")
                or n == "corpus_pipeline.py" and left != "pipeline"]

    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=skip)
    if left == "empty folder":
        (copy / "airloom" / "llm").mkdir()
    done = subprocess.run([sys.executable, "-c", CHECK], cwd=copy, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": str(copy)})
    assert done.returncode == 0, done.stderr
