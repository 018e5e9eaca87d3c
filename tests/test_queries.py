"""Every registered query equals its SQL on the smallest tables, column types included."""

import compare
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
# operators on documents have tests of their own
QUERIES = {n: q for n, q in entry.queries().items() if not (n == "pipeline" or n.startswith("op"))}
SQL = {n: s for n, s in entry.oracle_sql().items() if not n.startswith("op")}


@pytest.fixture(scope="module")
def database():
    return compare.database(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, database, name):
    assert compare.differences(database, SQL[name], QUERIES[name](spark, FOLDER)) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["order_month", "revenue", "order_count"]
    assert entry.entry(spark).count() == 80
