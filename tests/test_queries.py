"""Every registered query against its SQL on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as contract
from wordloom.plans.oracle import ORACLE
from wordloom.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    relation = database.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    order = [relation.columns.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got == expected
    assert got


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["word", "neighbor", "cnt"]
    assert df.count() > 0
