"""Every registered query against its SQL twin over the smallest given tables."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as driver
from millrace.plans.catalog import catalog
from millrace.plans.catalog_sql import ORACLES
from oracle import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(catalog()) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_twin(spark, duck, name):
    assert difference(duck, driver.queries()[name](spark, FOLDER), driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1
