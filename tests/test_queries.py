"""Every registered query against its SQL equivalent."""

import pytest
from comparison import difference, duck

import __spark_entry__ as contract
from casebeacon.plans import catalog, oracle

QUERIES, ORACLE = catalog.QUERIES, oracle.ORACLE


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    rates = [r["positivity_rate_pct"] for r in rows]
    assert rows and rates == sorted(rates, reverse=True)
