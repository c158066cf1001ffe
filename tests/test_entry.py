"""The entry module without the training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_works_without_the_subpackage(tmp_path):
    gone = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "*.json", "*.md")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=gone)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "repo", check=True, timeout=60)
