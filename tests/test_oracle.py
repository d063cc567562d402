"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as registered
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with connect(SF_DIR) as connection:
        yield connection


@pytest.mark.parametrize("name", registered.oracle_sql())
def test_query_agrees_with_sql(spark, connection, name):
    query, sql = registered.queries()[name], registered.oracle_sql()[name]
    assert difference(spark, connection, query, sql, SF_DIR) is None


def test_entry_has_rows_and_both_verdicts(spark):
    rows = registered.entry(spark).collect()
    assert {row["constraint_status"] for row in rows} == {"Success", "Failure"}
