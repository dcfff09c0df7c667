"""The registry: names, columns, and that the library stands without the corpus operators."""

import subprocess
import sys
import textwrap
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_and_registry(spark):
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as e

    assert e.entry(spark).count() == 200
    assert set(e.oracle_sql()) <= set(e.queries()) and "topic_vote_status" in e.oracle_sql()


def test_without_corpus_operators(tmp_path):
    """Copies all but the optional package and imports the registry there."""
    code = f"""
        import shutil, sys
        shutil.copytree({str(ROOT / "quillmine")!r}, {str(tmp_path / "quillmine")!r}, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        shutil.copy({str(ROOT / "__spark_entry__.py")!r}, {str(tmp_path)!r})
        sys.path[:0] = [{str(tmp_path)!r}]
        import __spark_entry__ as e
        assert "topic_vote_status" in e.queries() and not any(n.startswith("op") for n in e.queries()) and "pipeline" not in e.queries()
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
