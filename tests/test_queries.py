"""Every query with SQL equals it on the smallest tables; the rest imports without the training-data operators."""

from __future__ import annotations

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from siltworks.plans import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, tables, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), tables.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted(tuple(str(None if x != x else x) for x in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_training_operators(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.symlink(f"{root}/__spark_entry__.py", tmp_path / "__spark_entry__.py")
    os.mkdir(tmp_path / "siltworks")
    for name in os.listdir(f"{root}/siltworks"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{root}/siltworks/{name}", tmp_path / "siltworks" / name)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert said.stdout.strip() == str(len(queries.QUERIES)), said.stderr
