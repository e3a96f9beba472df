"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from checks.compare import connect, differences
from checks.oracle import SQL
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    rows, found = differences(spark, con, SF_DIR, name)
    assert rows > 0 and not found


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).columns[0] == "query"


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
