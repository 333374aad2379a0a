"""The entry module works without the training-data subpackage."""

import subprocess
import sys

from conftest import ROOT

PROBE = """
import sys
for name in ("lumenlog.llm", "corpus_pipeline"):
    sys.modules[name] = None
import __spark_entry__ as e
assert e.queries() and not [q for q in e.queries() if q.startswith("op")]
assert set(e.oracle_sql()) <= set(e.queries())
"""


def test_entry_imports_without_llm():
    subprocess.run([sys.executable, "-c", PROBE], cwd=ROOT, check=True, timeout=120)
