"""The entry stands without the training-data operators and without the libraries that they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ABSENT = """
import importlib.abc, sys
class Absent(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), "lineitem_statistics" in e.queries(), any(q.startswith("op") for q in e.queries() if q[2:3].isdigit()))
"""


@pytest.mark.parametrize("name", ["ahocorasick", "public_tokenizers", "corpus_pipeline", "sluiceway.llm"])
def test_the_other_queries_stand_alone(name):
    done = subprocess.run(
        [sys.executable, "-W", "ignore", "-c", ABSENT.format(name=name)], cwd=ROOT, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr[-500:]
    n, sql, known, theirs = done.stdout.split()
    assert int(n) > 150 and int(sql) == int(n) and known == "True" and theirs == "False"
