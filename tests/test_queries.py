"""Every registered query against its SQL."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from crossmap.plans.oracle import ORACLE
from crossmap.plans.queries import REGISTERED
from tests.compare import compare, database

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


#: Reports of how much work was left out; tests/test_pivots.py and tests/test_repair.py hold them against brute force.
WITHOUT_SQL = {"pruned_tiles", "repair_counts"}


def test_every_query_has_sql():
    assert set(REGISTERED) == set(ORACLE) | WITHOUT_SQL
    assert set(REGISTERED) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_works_without_the_operators_for_training_data(tmp_path):
    root = Path(entry.__file__).parent
    shutil.copytree(root / "crossmap", tmp_path / "crossmap", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(entry.__file__, tmp_path)
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries()))"], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert said.stdout.split() == sorted(REGISTERED), said.stderr


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
