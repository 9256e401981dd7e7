"""The entry without the optional folder, as it is when that has been taken away."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from filmlake.plans.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_entry_imports_without_the_training_data_operators(tmp_path, with_pipeline):
    shutil.copytree(ROOT / "filmlake", tmp_path / "filmlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    names = ["__spark_entry__.py", *(["corpus_pipeline.py"] if with_pipeline and (ROOT / "corpus_pipeline.py").exists() else [])]
    for name in names:
        shutil.copy(ROOT / name, tmp_path / name)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.queries()) == set(e.oracle_sql())"
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == sorted(QUERIES)
