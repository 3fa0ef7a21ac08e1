"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as registered
from oracle import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names_agree():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query(spark, con, name):
    """Queries without SQL are compared with brute force in tests of their own."""
    assert difference(registered.queries()[name](spark, SF), con, registered.oracle_sql()[name]) is None
