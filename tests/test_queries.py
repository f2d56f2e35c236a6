"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, difference, duck_rows, spark_rows

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    got = spark_rows(queries()[name](spark, SF_DIR))
    assert got[1], "a query without rows checks nothing"
    assert difference(got, duck_rows(duck, oracle_sql()[name])) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_rows_without_sql(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
