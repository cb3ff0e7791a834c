"""Every registered query against its SQL, run by DuckDB on the same files."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from patchloom.plans import registered

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def _normal(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in found)


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query(spark, duck, name):
    result = contract.queries()[name](spark, FOLDER)
    found = [tuple(r) for r in result.collect()]
    assert found, "no rows"
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return
    cursor = duck.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert _normal(found, result.columns) == _normal(cursor.fetchall(), columns)


def test_entry_runs(spark):
    report = contract.entry(spark)
    assert report.columns == ["metric_name", "candidate", "baseline", "threshold", "higher_is_better", "passed"]
    assert {r["metric_name"] for r in report.collect()} == {"f1_score", "precision", "recall", "accuracy"}


def test_sql_names_are_registered():
    assert set(contract.oracle_sql()) <= set(contract.queries())
