"""The entry module works without the optional corpus subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_corpus_subpackage(tmp_path):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py", "tests", "spark-warehouse")
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    code = "import __spark_entry__ as e; n = e.queries(); assert 'dust_current_grades' in n and not any(x.startswith('op') for x in n); e.oracle_sql()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": ""})
