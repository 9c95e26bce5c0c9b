"""Every registered query against its SQL, at the smallest size."""

import os

import pytest

import __spark_entry__ as entry_point
from compare import connect, duck_rows, spark_rows
from tripmill.checks.oracle import all_oracles
from tripmill.checks.queries import all_queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, FOLDER))
    expected_columns, expected = duck_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected) > 0
    assert rows == expected
