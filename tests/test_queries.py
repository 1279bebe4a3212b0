"""Every registered query against its SQL, at the smallest scale."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    values = [
        tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else str(r[i]) for i in order)
        for r in rows
    ]
    return sorted(columns), sorted(values)


def delivery_queries():
    others = contract._llm.queries() if contract._llm else {}
    return [name for name in contract.queries() if name not in others]


def test_every_query_has_sql():
    assert set(delivery_queries()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", delivery_queries())
def test_query(spark, oracle, name):
    df = contract.queries()[name](spark, SF_DIR)
    expected = oracle.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    got = normalized(df.columns, [tuple(r) for r in df.collect()])
    assert got == normalized(columns, expected.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "subscription" and df.count() == 1500
