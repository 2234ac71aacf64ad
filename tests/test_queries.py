"""Every registered query against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as driver
from paystrata.plans.queries import QUERIES
from compare import connect, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    columns, found = spark_rows(driver.queries()[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(db, driver.oracle_sql()[name])
    assert columns == expected_columns
    assert found == expected and found


def test_entry(spark):
    assert driver.entry(spark).count() == 610
