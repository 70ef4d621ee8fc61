"""The entry file works with and without the training-data subpackage."""

import os
import subprocess
import sys

from conftest import ROOT


def test_queries_and_oracles_fit_together():
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_imports_without_the_subpackage():
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.split('.')[:2] == ['tessera', 'llm'] or name == 'corpus_pipeline':\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "q = e.queries()\n"
            "assert 'feature_profile' in q and not any(n.startswith('op') for n in q) and 'pipeline' not in q\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, env=os.environ | {"PYTHONPATH": ROOT})
