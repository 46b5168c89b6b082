"""Every query with an oracle gives exactly the oracle's rows on the small test tables."""

import pytest
from conftest import SF
from oracle_check import difference, oracle_connection

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, oracle, name):
    assert difference(QUERIES[name](spark, SF), oracle, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
