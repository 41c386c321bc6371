"""The driver contract without the optional operators, or without a library that only they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
SCRIPT = """
import importlib.abc, sys
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as E
assert E.llm is None and len(E.queries()) > 80 and set(E.oracle_sql()) <= set(E.queries())
assert not any(q.startswith("op1_") or q == "pipeline" for q in E.queries())
"""


@pytest.mark.parametrize("name,warned", [("public_tokenizers", True), ("mentionlab.llm", False), ("corpus_pipeline", False)])
def test_other_queries_stay_without(name, warned):
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert ("left out" in out.stderr) == warned
