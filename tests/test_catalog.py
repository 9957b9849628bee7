"""Every query with SQL against DuckDB on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def plain(value):
    if value is None or pd.isna(value):
        return "null"
    if isinstance(value, float):  # whole numbers with nulls are floats on one side only
        return str(int(value)) if value.is_integer() else repr(value)
    return str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(plain(v) for v in row) for row in frame.itertuples(index=False))


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, sf_dir, duck):
    ours, theirs = QUERIES[name](spark, sf_dir).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
