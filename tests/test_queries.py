import pytest

import __spark_entry__ as contract
from tidemark.plans import ORACLES, QUERIES
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    assert differences(df, duck, ORACLES[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
