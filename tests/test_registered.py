"""Every registered query against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from tabflow.checks.oracles import ORACLES
from tabflow.checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_works_without_the_training_data_folder(tmp_path, pipeline):
    """In a copy without that folder, with and without the pipeline that is made of it."""
    root = Path(entry_point.__file__).parent
    ignored = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(root / "tabflow", tmp_path / "tabflow", ignore=ignored)
    shutil.copytree(root / "tests", tmp_path / "tests", ignore=ignored)
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    if pipeline and (root / "corpus_pipeline.py").exists():
        shutil.copy(root / "corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    run = {"cwd": tmp_path, "env": {**os.environ, "PYTHONPATH": ""}, "capture_output": True, "text": True}
    found = subprocess.run([sys.executable, "-c", code], check=True, **run)
    queries, oracles = (line.split() for line in found.stdout.splitlines())
    assert set(queries) == set(QUERIES) and set(oracles) == set(ORACLES)
    collected = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only"], **run)
    assert collected.returncode == 0, collected.stdout


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["id", "uniq"]


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, oracle, name):
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    expected = oracle.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = sorted((tuple(r[i] for i in order) for r in expected.fetchall()), key=repr)
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == wanted
    assert wanted
