"""Every registered query against its SQL on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract  # registers every query
from tallyloom.plans.catalogue import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = contract.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    got = [tuple(row[c] for c in columns) for row in frame.collect()]
    expected = duck.sql(contract.oracle_sql()[name])
    assert columns == sorted(expected.columns)
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    assert {f.name: f.dataType.simpleString() for f in frame.schema} == {c: TYPES[kinds[c]] for c in columns}
    order = [expected.columns.index(c) for c in columns]
    want = [tuple(row[i] for i in order) for row in expected.fetchall()]
    assert want
    assert comparable(got) == comparable(want)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
