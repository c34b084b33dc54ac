"""Every registered query against the same question asked in SQL of another engine."""

import math
import os
from datetime import date
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from strikeloom.checks.oracle import SQL
from strikeloom.checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "NaN" if math.isnan(value) else repr(value)
        return str(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    answer = duck.execute(SQL[name])
    expected_columns = [column[0] for column in answer.description]
    expected = answer.fetchall()
    rows = frame.collect()
    assert sorted(frame.columns) == sorted(expected_columns)
    assert expected, "the check would be empty"
    by_name = dict(zip(frame.columns, zip(*rows))) if rows else {}
    wanted = dict(zip(expected_columns, zip(*expected)))
    for column, values in by_name.items():
        kinds = {type(v) for v in values if v is not None}
        assert kinds == {type(v) for v in wanted[column] if v is not None}, column
        assert not kinds & {Decimal}, column
        assert kinds <= {str, int, float, bool, date}, column
    assert comparable(rows, frame.columns) == comparable(expected, expected_columns)
