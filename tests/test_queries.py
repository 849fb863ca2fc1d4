"""Every registered query against its SQL answer at the smallest scale."""

import pytest

import __spark_entry__ as contract
from tests.compare import connect, mismatch
from terrace.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert mismatch(df, con, ORACLES[name]) is None
    else:
        assert df.count() >= 0


def test_contract(spark):
    assert contract.queries().keys() >= QUERIES.keys()
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
