"""Every query of the subpackage that has a SQL twin, over the smallest given tables."""

import os
from pathlib import Path

import pytest

from millrace.llm.queries import ORACLES, QUERIES
from oracle import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_twin(spark, name):
    assert difference(connect(FOLDER), QUERIES[name](spark, FOLDER), ORACLES[name]) is None
