"""Every registered query against the same question in SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import registered
from oracle import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_names_are_well_formed():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 200
    # The training-data subpackage is optional, and trained or sampled results have no SQL; tests/llm covers those.
    assert len(registered.QUERIES) - len(registered.ORACLES) < 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, sf, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], sf) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
