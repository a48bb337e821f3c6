"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{data}/{f}'")
    return con


def _cell(v):
    if v is None or v is pd.NA or isinstance(v, float) and np.isnan(v):
        return "∅"
    if isinstance(v, (bool, np.bool_, str)):
        return str(v)
    if isinstance(v, (int, float, np.number)):
        return f"{float(v):.9g}" if float(v) != 0 else "0"
    return str(v)


def _rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(_cell(v) for v in row) for row in pdf.astype(object).itertuples(index=False, name=None))


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, data, name):
    got, want = QUERIES[name](spark, data).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, data, name):
    df = QUERIES[name](spark, data)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
