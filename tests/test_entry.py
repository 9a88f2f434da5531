"""The entry keeps the core queries whatever the optional parts lack."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["riskloom.llm", "tiktoken", "zstandard", "corpus_pipeline"])
def test_core_queries_without_optional_parts(missing):
    program = f"""
import sys
sys.modules[{missing!r}] = None  # importing it fails
import __spark_entry__ as entry
from riskloom.plans.queries import QUERIES
assert set(QUERIES) <= set(entry.queries()), "core queries are gone"
assert set(entry.oracle_sql()) <= set(entry.queries())
assert ("pipeline" in entry.queries()) == ({missing!r} == "zstandard")  # needs no compression itself
"""
    done = subprocess.run([sys.executable, "-c", program], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "left out" in done.stderr
