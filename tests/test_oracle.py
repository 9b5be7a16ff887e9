"""Every registered query against independent SQL on a second engine."""

import pytest

import __spark_entry__ as contract
from quartermark.plans import oracle, registry
from tests.compare import connect, differences

# The reference's own operators; the corpus operators have tests of their own.
QUERIES = registry.QUERIES
ORACLE = oracle.ORACLE


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(name, spark, con, sf_dir):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() == 5
