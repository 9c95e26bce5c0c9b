"""The entry points where the training-data operators cannot be imported."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
sys.modules[{blocked!r}] = None
import __spark_entry__ as entry
from tripmill.checks.queries import all_queries
assert set(entry.queries()) == set(all_queries()) == set(entry.oracle_sql()), sorted(entry.queries())
"""


@pytest.mark.parametrize("blocked", ["public_tokenizers", "zstandard", "tripmill.llm", "corpus_pipeline"])
def test_base_queries_survive_a_missing_package(blocked):
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert "without training-data queries" in run.stderr
