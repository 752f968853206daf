"""The library loads and answers without the subpackage for training data."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
sys.path.insert(0, ".")
import __spark_entry__ as registry
assert registry.__file__.startswith({home!r}), registry.__file__
names = set(registry.queries())
assert "rsi" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(registry.oracle_sql()) <= names
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("rows", registry.entry(spark).limit(3).count())
"""


def test_loads_without_llm(tmp_path):
    home = tmp_path / "copy"
    home.mkdir()
    shutil.copytree(ROOT / "barmart", home / "barmart", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, home / name)
    done = subprocess.run([sys.executable, "-c", CODE.format(home=str(home))], cwd=home, capture_output=True, text=True, timeout=300)
    assert "rows 3" in done.stdout, done.stderr[-2000:]
