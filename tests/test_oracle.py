"""Every query with SQL gives the rows its SQL gives."""

import pytest

from __spark_entry__ import entry
from tidemill.plans.queries import ORACLE, QUERIES
from compare import database, difference, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    got = spark_rows(QUERIES[name](spark, FOLDER))
    assert got[1], "no rows"
    assert difference(got, sql_rows(con, ORACLE[name])) is None
