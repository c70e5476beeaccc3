"""The rest works where the corpus operators and their tests are not there, with the pipeline's file or without."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
SAY = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"
#: The parent's, so that what it can import is found there too; but for what names this repository.
ENV = os.environ | {"PYSPARK_PYTHON": sys.executable, "PYTHONPATH": os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not Path(p).resolve().is_relative_to(REPO))}


@pytest.fixture
def copy(tmp_path):
    """All of the repository but the two folders."""
    left_out = shutil.ignore_patterns("llm", "__pycache__", ".git", ".pytest_cache", "spark-warehouse", "artifacts")
    shutil.copytree(REPO, tmp_path / "copy", ignore=left_out)
    assert not list((tmp_path / "copy").rglob("llm"))
    return tmp_path / "copy"


def python(copy, *args):
    return subprocess.run([sys.executable, *args], cwd=copy, capture_output=True, text=True, env=ENV, timeout=900)


@pytest.mark.parametrize("pipeline_too", [False, True])
def test_entry_without_llm(copy, pipeline_too):
    if (copy / "corpus_pipeline.py").exists() and not pipeline_too:
        (copy / "corpus_pipeline.py").unlink()
    said = python(copy, "-c", SAY)
    assert said.returncode == 0, said.stderr
    n, pipeline, sql = said.stdout.split()
    assert int(n) > 30 and (pipeline, sql) == ("False", "True")


def test_the_other_tests_without_llm(copy):
    """All of them are collected there; those of the operators and sources but the slow ones, and some of the queries, are run."""
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    collected = python(copy, "-m", "pytest", "tests", "--collect-only", "-q")
    assert collected.returncode == 0, collected.stdout[-3000:] + collected.stderr[-3000:]
    others = [p.name for p in (copy / "tests").glob("test_*.py") if p.name not in ("test_without_llm.py", "test_queries.py")]
    said = python(copy, "-m", "pytest", "-x", "-q", "-p", "no:cacheprovider", "-m", "not slow", *(f"tests/{n}" for n in others), "tests/test_queries.py::test_entry", "tests/test_queries.py::test_all_have_sql")
    assert said.returncode == 0, said.stdout[-3000:]


def test_nothing_imports_llm():
    for path in (REPO / "tidebook").rglob("*.py"):
        if "llm" not in path.relative_to(REPO).parts:
            assert "llm" not in path.read_text(), path
