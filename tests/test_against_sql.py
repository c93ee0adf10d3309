"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import compare
import pytest

import __spark_entry__

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = __spark_entry__.queries()
SQL = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


def test_every_query_has_its_sql():
    """The operators on documents and vectors are tested beside their code."""
    others = {name for name in QUERIES if name.startswith("op") or name == "pipeline"}
    assert set(QUERIES) - others == set(SQL) - others


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, duck, name):
    names, rows = compare.spark_rows(QUERIES[name](spark, FOLDER))
    expected_names, expected = compare.duck_rows(duck, SQL[name])
    assert names == expected_names
    assert rows == expected
    assert rows


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert rows
    units = [row.total_units_sold for row in rows]
    assert units == sorted(units, reverse=True)
