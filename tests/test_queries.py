"""Every registered query against its SQL on the given tables."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, Decimal):
        return str(value.normalize())
    return "NULL" if value is None else str(value)


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    content = sorted(tuple(normal(row[i]) for i in order) for row in rows)
    return [names[i] for i in order], content


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    found = table_of(result.columns, result.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert found[1]
        return
    expected = duck.execute(sql)
    names = [column[0] for column in expected.description]
    assert found == table_of(names, expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["table_name", "n"]
