"""The package works without the text operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
PROBE = """
import __spark_entry__ as entry
from agroflow.session import with_settings
from pyspark.sql import SparkSession
names = set(entry.queries())
assert "pipeline" not in names and not any(n.startswith("op") for n in names), names
assert set(entry.oracle_sql()) <= names
spark = with_settings(SparkSession.builder.master("local[2]")).config("spark.ui.enabled", "false").getOrCreate()
assert entry.queries()["range_classify"](spark, entry.SMALL).count() > 0
"""


def copy(tmp_path, *left_out):
    shutil.copytree(ROOT / "agroflow", tmp_path / "agroflow", ignore=shutil.ignore_patterns("__pycache__", *left_out))
    shutil.copytree(ROOT / "checks", tmp_path / "checks", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)


def run(tmp_path):
    return subprocess.run([sys.executable, "-c", PROBE], cwd=tmp_path, capture_output=True, text=True, timeout=300)


def test_without_the_subpackage_the_pipeline_is_left_out_too(tmp_path):
    copy(tmp_path, "llm")
    if (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    done = run(tmp_path)
    assert done.returncode == 0, done.stderr


def test_without_both(tmp_path):
    copy(tmp_path, "llm")
    done = run(tmp_path)
    assert done.returncode == 0, done.stderr
