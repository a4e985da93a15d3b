"""Registered queries against their DuckDB SQL on the same Parquet files."""

import os
from pathlib import Path

import duckdb
import pytest

from parcelyard.llm import queries, sql

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", list(sql.QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    result = duck.sql(sql.QUERIES[name])
    assert sorted(result.columns) == columns
    types = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}
    assert {c: types[t] for c, t in frame.dtypes} == dict(
        zip(result.columns, map(str, result.types))
    )
    got = sorted(repr(tuple(r)) for r in frame.select(*columns).collect())
    assert got == sorted(map(repr, result.select(*columns).fetchall()))
