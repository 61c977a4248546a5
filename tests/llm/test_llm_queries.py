"""The queries that SQL can express, against that SQL."""

import os

import pytest

import compare
from millrace.llm import queries as llm

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query(spark, name):
    problem, rows = compare.outcome(llm.QUERIES[name](spark, SF), compare.connect(SF), llm.ORACLES[name])
    assert problem is None and rows > 0
