"""Every registered query against its reference SQL on the smallest tables."""

from __future__ import annotations

import datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import oracle
from tillsight.plans.registry import named_queries

SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return value.date()
    return value


def table(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_reference_sql():
    assert set(named_queries()) == set(SQL)
    assert set(SQL) <= set(contract.queries()) and SQL.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, folder, database, name):
    found = contract.queries()[name](spark, folder)
    expected = database.execute(SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(found.columns) == sorted(columns)
    assert table(found.columns, found.collect()) == table(columns, expected.fetchall())


def test_entry(spark, folder):
    assert contract.entry(spark).count() == 80
