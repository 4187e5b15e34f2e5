"""Every query against its SQL, run by DuckDB over the same tables."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import SF_DIR
from fixture_contracts import TABLES

ORACLES = driver.contract_sql()
QUERIES = driver.contract_queries()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    rows = Counter(tuple(plain(v) for v in row) for row in found.select(*columns).collect())
    result = duck.execute(ORACLES[name])
    names = [entry[0] for entry in result.description]
    assert sorted(names) == columns
    places = [names.index(column) for column in columns]
    expected = Counter(tuple(plain(row[p]) for p in places) for row in result.fetchall())
    assert rows == expected
    assert rows, "a query without rows shows nothing"


def test_entry(spark):
    assert driver.entry(spark).columns == driver.REPORT_COLUMNS
