"""Every query with SQL, against it, on the smallest tables."""

import pytest
from check_oracles import connect, difference
from conftest import SMALL

import __spark_entry__ as entry
from tierwise.plans.oracles import ORACLES
from tierwise.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_entry_points(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 2


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None
