"""The entry works without the training-data subpackage, or without what it needs."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CHECK = """
import sys

class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name in {blocked}:
            raise ModuleNotFoundError(name)

sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
from oracle_duckdb import SQL
from tradeflow.queries import QUERIES

print(set(entry.queries()) - set(QUERIES), set(entry.oracle_sql()) - set(SQL), set(QUERIES) <= set(entry.queries()))
"""


@pytest.mark.parametrize("blocked", [("tradeflow.llm",), ("tradeflow.llm", "corpus_pipeline"), ("public_tokenizers",)])
def test_core_queries_stand_alone(blocked):
    out = subprocess.run([sys.executable, "-c", CHECK.format(blocked=set(blocked))], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip() == "set() set() True"
