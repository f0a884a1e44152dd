"""Every registered query against its SQL partner over the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tests.compare import difference, open_tables
from workload.catalog import QUERIES
from workload.oracle import ORACLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


def test_every_query_has_a_partner():
    """Queries of the optional package may have none; their own tests check them by brute force."""
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, tables, name):
    assert difference(driver.queries()[name](spark, FOLDER), tables, driver.oracle_sql()[name]) is None
