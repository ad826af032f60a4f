"""Every check query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as driver
import oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.QUERIES))
def test_query(spark, duck, name):
    found = driver.queries()[name](spark, FOLDER)
    sql = driver.oracle_sql().get(name)
    if sql:
        assert oracle.compare(found, duck, sql) == []
    else:
        assert found.count() > 0
