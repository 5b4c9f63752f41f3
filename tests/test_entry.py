"""The entry file in copies of the library that lack the corpus operators, or what they need."""

import json
import shutil
import subprocess
import sys

from conftest import ROOT

from recfold.plans import registry

LIST = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def listed(folder):
    done = subprocess.run([sys.executable, "-B", "-c", LIST], cwd=folder, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    return json.loads(done.stdout.splitlines()[-1])


def copy_of(folder, *left_out):
    skip = shutil.ignore_patterns(".git", "__pycache__", *left_out)
    return shutil.copytree(ROOT, folder / "copy", ignore=skip)


def test_without_the_corpus_folders(tmp_path):
    """Both folders gone, the pipeline's file still there: every other query is listed."""
    names, oracles = listed(copy_of(tmp_path, "llm"))
    assert names == sorted(registry.QUERIES) and set(oracles) <= set(names)


def test_with_an_empty_folder_left_behind(tmp_path):
    folder = copy_of(tmp_path, "llm")
    (folder / "recfold" / "llm").mkdir()
    assert listed(folder)[0] == sorted(registry.QUERIES)


def test_without_a_library_of_the_corpus_operators(tmp_path):
    folder = copy_of(tmp_path)
    (folder / "regex.py").write_text("raise ModuleNotFoundError('regex')\n")
    assert listed(folder)[0] == sorted(registry.QUERIES)
