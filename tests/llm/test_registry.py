"""What is registered, and that the rest stands without this folder."""

import os
import re
import subprocess
import sys

from kinfold.llm import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_one_query_for_each_operator():
    numbers = [re.match(r"op(\d+)_", n)[1] for n in catalog.QUERIES]
    assert sorted(map(int, numbers)) == list(range(1, 14))


def test_nothing_else_imports_the_folder():
    for top, _, names in os.walk(os.path.join(ROOT, "kinfold")):
        if "llm" in os.path.relpath(top, ROOT).split(os.sep):
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(top, name), encoding="utf-8") as f:
                    assert "llm" not in f.read(), name


def test_entry_imports_without_the_folder_and_the_pipeline():
    code = (
        "import sys, importlib.abc\n"
        "class Hide(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('kinfold.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Hide())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 100 and len(e.oracle_sql()) > 100 and not any(n.startswith('op1_') for n in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
