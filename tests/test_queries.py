"""Every registered query against its SQL on the small tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def database(small):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_of_the_library_has_an_oracle():
    from tidegate.plans.queries import ORACLES, QUERIES

    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("query", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, database, small, query):
    df = contract.queries()[query](spark, small)
    expected = database.execute(contract.oracle_sql()[query])
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, df.collect()) == canonical(names, expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
