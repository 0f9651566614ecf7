"""The library stands without the optional subpackage and the pipeline made of it."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SCRIPT = """
import __spark_entry__ as e
from loanmart.session import local_session
assert not any(n == "pipeline" or n.startswith("op") for n in e.queries()) and set(e.oracle_sql()) <= set(e.queries())
assert len(e.queries()) > 90 and e.entry(local_session("bare", cores="2")).columns[0] == "date_vyd_d"
"""


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_tree_without_llm(tmp_path, also):
    at = tmp_path / "tree"
    shutil.copytree(ROOT, at, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", ".pytest_cache", *also))
    assert not (at / "loanmart/llm").exists() and not (at / "tests/llm").exists()
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=at, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    listed = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"], cwd=at, capture_output=True, text=True)
    assert listed.returncode == 0, listed.stdout[-2000:]
