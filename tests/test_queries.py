"""Every registered query against its check SQL on the same tables."""

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check import TABLES, rows_of

QUERIES, CHECKS = spark_entry.queries(), spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def database(folder):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, folder, database):
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    if name not in CHECKS:
        assert sum(got.values()) > 0
        return
    result = database.execute(CHECKS[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
