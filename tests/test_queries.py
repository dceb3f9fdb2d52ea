"""Every registered query against its SQL, on the smallest tables."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as driver
from check import differences, oracle
from workload import queries as ours

QUERIES, SQL = ours.QUERIES, driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(SQL) and set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    assert differences(found, duck.execute(SQL[name]).df()) == ""
    assert len(found)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
