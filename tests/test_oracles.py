import re

import pytest

import __spark_entry__ as entry
from compare import connect, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.01"
#: Queries of the optional subpackage have their own tests.
OPTIONAL = re.compile(r"op\d+_|pipeline$")
QUERIES, SQL = (
    {k: v for k, v in of.items() if not OPTIONAL.match(k)}
    for of in (entry.queries(), entry.oracle_sql())
)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duck_rows(duck, SQL[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows, "a check over no rows says nothing"


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
