"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, canonical

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return connection


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if name not in ORACLES:
        assert got
        return
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == canonical(answer.fetchall(), columns)
