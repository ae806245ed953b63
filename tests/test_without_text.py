"""The rest of the library where the text operators have been taken out."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
LISTED = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"


@pytest.mark.parametrize("without_pipeline", [True, False])
def test_queries_without_text_operators(tmp_path, without_pipeline):
    unwanted = shutil.ignore_patterns(
        ".git", "llm", "__pycache__", "corpus_pipeline.py" if without_pipeline else ".git"
    )
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=unwanted)
    got = subprocess.run(
        [sys.executable, "-c", LISTED], cwd=copy, capture_output=True, text=True, timeout=120
    )
    assert got.returncode == 0, got.stderr
    names = got.stdout.split()
    assert "total_occupancy" in names and "pipeline" not in names
    assert not any(name.startswith("op1_") for name in names)
