"""Every registered query against its DuckDB SQL on the same Parquet files."""

import os
from pathlib import Path

import duckdb
import pytest

import oracle
from parcelyard.plans import catalogue

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
SQL = oracle.oracle_sql()

# DuckDB type by Spark type, for a comparison of schemas.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def multiset(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(SQL) == set(catalogue.QUERIES)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = catalogue.named(name)(spark, SF_DIR)
    result = duck.sql(SQL[name])
    columns = sorted(frame.columns)
    assert sorted(result.columns) == columns
    expected_types = dict(zip(result.columns, map(str, result.types)))
    assert {c: TYPES[t] for c, t in frame.dtypes} == expected_types
    got = multiset(tuple(r) for r in frame.select(*columns).collect())
    want = multiset(result.select(*columns).fetchall())
    assert got == want
