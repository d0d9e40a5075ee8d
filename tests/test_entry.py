import subprocess
import sys
from pathlib import Path

import pytest

TOP = Path(__file__).resolve().parents[1]
# what a missing package or folder looks like to the import system
BLOCK = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name}}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print(len(entry.queries()), "extract_points" in entry.queries(), any(q.startswith("op") or q == "pipeline" for q in entry.queries()))
"""


@pytest.mark.parametrize("name", ["zstandard", "gridseries.llm"])
def test_the_other_queries_do_without(name):
    done = subprocess.run([sys.executable, "-c", BLOCK.format(name=name)], cwd=TOP, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    count, known, extra = done.stdout.split()
    assert int(count) > 80 and known == "True" and extra == "False" and "without the training-data operators" in done.stderr


def test_a_missing_pipeline_costs_only_itself():
    done = subprocess.run([sys.executable, "-c", BLOCK.format(name="corpus_pipeline")], cwd=TOP, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "pipeline" not in done.stdout
