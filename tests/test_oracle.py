"""Every registered query against its SQL, on the given tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference
from tillroll.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, key):
    assert difference(QUERIES[key](spark, SF_DIR), duck, ORACLES[key]) is None


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_every_query_is_registered():
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).count() == 3
