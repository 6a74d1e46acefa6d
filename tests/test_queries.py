"""Every registered query against its SQL, on whole tables."""

import datetime as dt
import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from frames import SMALL
from tallybook.catalog import registry

QUERIES = {name: fn for name, (fn, _) in registry().items()}
SQL = {name: sql for name, (_, sql) in registry().items() if sql}
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SMALL}/{file}'")
    return con


def comparable(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(comparable(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    expected = duck.sql(SQL[name])
    kinds = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    want = rows_of(expected.columns, expected.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == want
    assert got, "a query over whole tables should find something"


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_entry_points_list_the_catalog():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_points_without_the_corpus_subpackage(tmp_path, with_pipeline):
    repo = Path(entry_points.__file__).parent
    shutil.copy(repo / "__spark_entry__.py", tmp_path)
    if with_pipeline and (repo / "corpus_pipeline.py").exists():
        shutil.copy(repo / "corpus_pipeline.py", tmp_path)
    shutil.copytree(repo / "tallybook", tmp_path / "tallybook", ignore=shutil.ignore_patterns("llm"))
    code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    run = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    assert run.stdout.split() == sorted(QUERIES)
