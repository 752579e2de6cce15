"""The library without its optional folder."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CHECK = """
import __spark_entry__ as entry
names = set(entry.queries())
assert "top_pairs" in names and "bpe_training" in names and set(entry.oracle_sql()) <= names
assert "pipeline" not in names and not any(n.startswith("op1") for n in names)
"""


def test_imports_without_the_optional_folder(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "corpuskit", tmp_path / "corpuskit", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    done = subprocess.run([sys.executable, "-c", CHECK], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
