"""Every named query against its SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from playtide.plans import registry
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["user_id", "rank", "track_id"]


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None
