from __future__ import annotations

import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_the_rest_works_without_the_training_data_operators(tmp_path):
    shutil.copytree(ROOT / "rollweave", tmp_path / "rollweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'env_yield' in q and set(e.oracle_sql()) <= set(q) and 'op3_exact_dedup' not in q and 'pipeline' not in q"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_nothing_else_imports_them():
    for path in (ROOT / "rollweave").rglob("*.py"):
        if "llm" not in path.parts:
            assert "rollweave.llm" not in path.read_text(), path
