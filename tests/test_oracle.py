"""Every registered query against its SQL counterpart."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from tierline.plans.oracle import ORACLE
from tierline.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    yield connection
    connection.close()


def table_of(columns, records):
    order = sorted(range(len(columns)), key=lambda n: columns[n])

    def plain(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    values = sorted((tuple(plain(record[n]) for n in order) for record in records), key=str)
    return [columns[n] for n in order], values


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = entry_points.queries()[name](spark, FOLDER)
    answer = duck.execute(entry_points.oracle_sql()[name])
    columns = [column[0] for column in answer.description]
    expected = table_of(columns, answer.fetchall())
    got = table_of(frame.columns, [tuple(row) for row in frame.collect()])
    assert got == expected
    assert got[1] or name.startswith("archive")


def test_entry(spark):
    assert not entry_points.entry(spark).isEmpty()
