"""Every registered query against its SQL equivalent, and what must not occur in its plan."""

import os
import re
import shutil
import subprocess
import sys

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from kinfold.plans.registry import WITHOUT_SQL
from tests.oracle import TABLES, shape

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FOLDER = "/root/testdata/sf0.001"
# The corpus operators and their pipeline have tests of their own beside them.
QUERIES = {name: run for name, run in queries().items() if re.match(r"op\d|pipeline$", name) is None}
SQL = {name: sql for name, sql in oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def test_only_declared_queries_lack_sql():
    assert set(QUERIES) - set(SQL) == set(WITHOUT_SQL)


def test_works_without_the_corpus_operators(tmp_path):
    """A copy without the separable folders imports and has all other queries."""
    for name in ("kinfold", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    for pipeline in ("absent", "left over"):
        if pipeline == "left over" and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
            shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), tmp_path)
        code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
        shown = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
        assert shown.stdout.split() == sorted(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    mine = df.toPandas()
    if name in WITHOUT_SQL:
        assert len(mine) > 0
        return
    theirs = con.execute(SQL[name]).df()
    a, b = shape(mine), shape(theirs)
    assert list(a.columns) == list(b.columns)
    assert a.equals(b)


def test_entry(spark):
    assert entry(spark).count() == 10
