"""The package without its operators for training text."""

import importlib.util
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
HIDDEN = """
import importlib.util, sys
find = importlib.util.find_spec
def hidden(name, *args):
    if name.startswith("acctweave.llm"):
        raise ModuleNotFoundError(name)
    return find(name, *args)
importlib.util.find_spec = hidden
sys.modules["acctweave.llm"] = None
import __spark_entry__ as driver
from workload.queries import QUERIES
assert set(driver.queries()) == set(QUERIES) == set(driver.oracle_sql()), sorted(driver.queries())
"""


def test_the_other_queries_stay_without_the_subpackage():
    done = subprocess.run([sys.executable, "-c", HIDDEN], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_subpackage():
    own = [p for folder in ("acctweave", "workload") for p in (ROOT / folder).rglob("*.py")]
    for path in own:
        if "llm" not in path.relative_to(ROOT).parts:
            assert "acctweave.llm" not in path.read_text(), path
    assert importlib.util.find_spec("workload") is not None
