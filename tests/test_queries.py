"""Every registered query against its SQL on the smallest data set."""

import duckdb
import pytest
from conftest import ROOT  # noqa: F401 - puts the repository on the path

import __spark_entry__ as registered

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    return value


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", registered.queries())
def test_query(spark, duck, name):
    df = registered.queries()[name](spark, FOLDER)
    found = df.collect()
    sql = registered.oracle_sql().get(name)
    if sql is None:
        assert found
        return
    result = duck.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert by_name(df.columns, found) == by_name(columns, result.fetchall())


def test_entry(spark):
    assert registered.entry(spark).count() > 0
