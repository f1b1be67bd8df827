"""The driver's contract: names, and that the library stands without the document operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.count() > 0 and "interior_missing" in df.columns


def test_nothing_else_imports_the_document_operators():
    for path in (ROOT / "fringeline").rglob("*.py"):
        if "llm" not in path.parts:
            assert "fringeline.llm" not in path.read_text(), path


def test_imports_without_a_session_and_without_the_document_operators(tmp_path):
    import shutil

    shutil.copytree(ROOT / "fringeline", tmp_path / "fringeline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'd14_missing_bursts' in q and not any(n.startswith('op1_') or n == 'pipeline' for n in q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120)
