"""Every registered query against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as contract
from check import connect, difference
from tillstream.plans.oracle import ORACLE
from tillstream.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def db():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["stat_time", "id", "name", "amount"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, db, name):
    assert difference(contract.queries()[name](spark, FOLDER), db, contract.oracle_sql()[name]) is None
