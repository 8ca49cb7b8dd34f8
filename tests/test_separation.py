"""The library, its entry file and its SQL work where the optional text package is not there."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path
from shutil import copytree, ignore_patterns

import pytest

ROOT = Path(__file__).resolve().parents[1]
PROBE = """
import __spark_entry__ as contract
from tallymart.checks.oracle import all_sql
from tallymart.checks.registry import all_queries
assert set(contract.queries()) == set(all_queries())
assert set(contract.oracle_sql()) == set(all_sql())
print(contract.__file__)
"""


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_entry_file_without_the_text_package(tmp_path, also):
    gone = ignore_patterns("llm", ".git", "__pycache__", "*.json", *also)
    copy = copytree(ROOT, tmp_path / "copy", ignore=gone)
    assert not (copy / "tallymart" / "llm").exists() and not (copy / "tests" / "llm").exists()
    found = subprocess.run([sys.executable, "-c", PROBE], cwd=copy, capture_output=True, text=True)
    assert found.returncode == 0, found.stderr
    assert str(copy) in found.stdout


def test_nothing_else_imports_the_text_package():
    files = [p for p in ROOT.rglob("*.py") if "llm" not in p.parts and p.name != "corpus_pipeline.py"]
    # this file and the entry file name the package
    named = {p.name for p in files if "tallymart.llm" in p.read_text()}
    assert named <= {"__spark_entry__.py", "test_separation.py"}
