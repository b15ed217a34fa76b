"""The driver contract, with and without the optional corpus folders."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

REPO = Path(__file__).parents[1]


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() == 32
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_the_corpus_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'scenario_winter' in q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    assert subprocess.run([sys.executable, "-c", code], cwd=copy).returncode == 0


def test_nothing_else_imports_the_corpus_operators():
    for path in (REPO / "talus").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
