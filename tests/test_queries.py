"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from check import compare
from conftest import SF_DIR
from reelbook.plans.oracles import ORACLES
from reelbook.plans.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["username", "follower_count"]
    assert found.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    assert compare(spark, SF_DIR, name, QUERIES[name], ORACLES[name]) is None
