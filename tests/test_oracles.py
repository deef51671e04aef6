"""Every registered query against its SQL in DuckDB, with names, types and values."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from footfall.plans import queries as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(registered.queries()) <= set(contract.queries())
    assert set(registered.queries()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    expected_types = {column[0]: str(column[1]) for column in result.description}
    assert {field: TYPES[dtype] for field, dtype in df.dtypes} == expected_types
    columns = sorted(expected_types)
    positions = [[column[0] for column in result.description].index(name) for name in columns]
    expected = [tuple(row[i] for i in positions) for row in result.fetchall()]
    actual = [tuple(row) for row in df.select(*columns).collect()]
    assert actual, "no rows"
    assert _sorted(actual) == _sorted(expected)


def _sorted(rows):
    assert not any(isinstance(value, float) and math.isnan(value) for row in rows for value in row)
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])
