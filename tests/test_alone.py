"""The registry without the training-data operators and their libraries."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import __spark_entry__ as e
n = e.queries()
assert len(n) > 80 and not any(k.startswith("op") or k == "pipeline" for k in n), sorted(n)
assert set(e.oracle_sql()) <= set(n)
"""


def run(folder, code):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(folder)}, capture_output=True, text=True)


def copied(folder, *left_out):
    shutil.copytree(ROOT / "corvane", folder / "corvane", ignore=shutil.ignore_patterns("__pycache__", *left_out))
    shutil.copy(ROOT / "__spark_entry__.py", folder)
    return folder


def test_entry_without_the_folder(tmp_path):
    done = run(copied(tmp_path, "llm"), CODE)
    assert done.returncode == 0, done.stderr


@pytest.mark.parametrize("kind", ["ImportError", "ModuleNotFoundError"])
def test_entry_where_the_folder_cannot_be_imported(tmp_path, kind):
    folder = copied(tmp_path, "llm")
    (folder / "corvane/llm").mkdir()
    (folder / "corvane/llm/__init__.py").write_text("")
    (folder / "corvane/llm/queries.py").write_text(f"raise {kind}('a library is missing')")
    done = run(folder, CODE)
    assert done.returncode == 0 and "a library is missing" in done.stderr


def test_other_errors_are_not_hidden(tmp_path):
    folder = copied(tmp_path, "llm")
    (folder / "corvane/llm").mkdir()
    (folder / "corvane/llm/__init__.py").write_text("")
    (folder / "corvane/llm/queries.py").write_text("1 / 0")
    assert "ZeroDivisionError" in run(folder, CODE).stderr


def test_nothing_else_names_the_folder():
    inside = [p for p in (ROOT / "corvane").rglob("*.py") if "llm" not in p.relative_to(ROOT).parts]
    assert inside and not any("corvane.llm" in p.read_text() or "corpus_pipeline" in p.read_text() for p in inside)
