"""The entry points with and without the corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("also", ["corpus_pipeline.py", "no other file"])
def test_entry_points_without_the_corpus_operators(tmp_path, also):
    left_out = shutil.ignore_patterns(".git", "llm", also, "__pycache__", "spark-warehouse", ".hypothesis")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=left_out)
    code = ("import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(q) == set(s) and len(q) > 50; "
            "assert 'pipeline' not in q")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_corpus_operators():
    for path in [*ROOT.glob("fleetwright/**/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts:
            assert "fleetwright.llm" not in path.read_text(), path
