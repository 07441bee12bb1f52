"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check import compare, open_oracle
from millrace.plans.oracle import ORACLE
from millrace.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SF)


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


# The text queries are tested beside their operators.
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    problem, n, _ = compare(spark, oracle, SF, name)
    assert problem is None
    assert n > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
