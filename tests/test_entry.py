"""The entry without the subpackage for training data, or without what that needs."""

import subprocess
import sys

from conftest import ROOT

HIDE = """
import sys, warnings
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
warnings.simplefilter("ignore")
import __spark_entry__ as e
print(len(e.queries()), any(q.startswith("op1_") for q in e.queries()), "catalog_products_list" in e.queries(), len(e.oracle_sql()) > 80)
"""


def test_missing_packages():
    for name in ("xxhash", "ahocorasick", "catalyne.llm", "corpus_pipeline"):
        out = subprocess.run([sys.executable, "-c", HIDE.format(name=name)], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
        assert int(out[0]) > 90 and out[1:] == ["False", "True", "True"], name
