"""The entry without the optional subpackage: everything else must work."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BLOCKED = """
import importlib.util, sys
find = importlib.util.find_spec
importlib.util.find_spec = lambda name, *a: None if name == "revmart.llm" else find(name, *a)
import __spark_entry__ as entry
names = entry.queries()
assert "vw_exec_kpi_scorecard" in names and "relation_profile" in names
assert not [n for n in names if n.startswith("op") or n == "pipeline"], names
assert set(entry.oracle_sql()) <= set(names)
assert "corpus_pipeline" not in sys.modules
"""


def test_entry_without_the_optional_subpackage():
    """corpus_pipeline.py may lie there while the subpackage does not."""
    subprocess.run([sys.executable, "-c", BLOCKED], cwd=ROOT, check=True, timeout=300)
