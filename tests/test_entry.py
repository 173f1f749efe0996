"""The driver's contract."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver
from vitrine.sources.shared import shared_dir


def test_entry_and_keys(spark):
    assert driver.entry(spark).columns
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_the_rest_stands_without_the_corpus_operators(tmp_path):
    root = Path(driver.__file__).parent
    for name in ("vitrine", "tests"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "pytest.ini"):
        shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as d; q = d.queries(); assert len(q) > 100 and 'pipeline' not in q and not any(k.startswith('op') for k in q); assert set(d.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
    found = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q"], cwd=tmp_path, capture_output=True, text=True)
    assert found.returncode == 0, found.stdout


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        shared_dir(Session(), "x")
