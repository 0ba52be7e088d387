"""The driver contract at sf0.001: entry() runs, every query equals its SQL oracle."""

import decimal
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from emporia.plans.catalog import build_queries

WAREHOUSE = sorted(build_queries())  # the training-data queries have tests of their own

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral() else format(v, "f")
    if hasattr(v, "asDict"):
        return str({k: _norm(x) for k, x in sorted(v.asDict().items())})
    if isinstance(v, dict):
        return str({k: _norm(x) for k, x in sorted(v.items())})
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return str(v)


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(f"{SF}/orders.parquet"):
        pytest.skip("checking tables not present")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark, con):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "recent_days" in df.columns


def test_every_query_has_oracle():
    assert set(WAREHOUSE) <= set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("name", WAREHOUSE)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want


def test_no_cartesian_or_nested_loop_joins(spark, con):
    """No registered query plans a cross product (all joins are equi-joins)."""
    bad = []
    built = entry.queries()
    for name in WAREHOUSE:
        plan = built[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        bad += [(name, op) for op in ("CartesianProduct", "BroadcastNestedLoopJoin") if op in plan]
    assert bad == []


def test_the_rest_works_without_the_training_data_folders(tmp_path):
    """Without ``emporia/llm`` and ``tests/llm`` (corpus_pipeline.py left or not) the entry imports and lists its queries."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for pipeline in (True, False):
        copy = tmp_path / f"copy-{pipeline}"
        gone = ["llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"])]
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns(*gone))
        code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": ""})
        n, n_sql, has_pipeline = out.stdout.split()
        assert int(n) >= 69 and int(n_sql) >= 69 and has_pipeline == "False"
