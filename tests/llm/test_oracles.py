"""Queries that have a SQL twin, against it."""

import os

import pytest
from oracle_compare import compare, duck

from wardflow.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no supplied tables")


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(FOLDER), FOLDER, name, ORACLES[name]) is None
