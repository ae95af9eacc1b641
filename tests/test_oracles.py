"""Every registered query against its SQL."""

import pytest
from compare import connect, differences

import __spark_entry__ as registered

# What is registered beyond these has tests of its own.
QUERIES, ORACLES = registered.QUERIES, registered.ORACLES


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, small, con, name):
    assert differences(QUERIES[name](spark, small), con, ORACLES[name]) is None


def test_entry(spark):
    assert registered.entry(spark).columns == [
        "primaryName",
        "averageRating",
        "movieCount",
        "weightedScore",
    ]
