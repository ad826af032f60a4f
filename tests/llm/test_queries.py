"""The registered corpus queries against their SQL."""

import pytest

import __spark_entry__ as driver
import oracle
from mergelane.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    assert oracle.compare(QUERIES[name](spark, FOLDER), oracle.connect(FOLDER), SQL[name]) == []


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert driver.queries().keys() >= {*QUERIES, "pipeline"} and driver.oracle_sql().keys() >= SQL.keys()
