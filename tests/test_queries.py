"""Every named query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry_points
from check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, con, name):
    state, note = compare(spark, con, FOLDER, name)
    assert state in ("ok", "rows"), note


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
