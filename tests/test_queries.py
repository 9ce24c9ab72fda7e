"""Every query gives the rows of its SQL."""

import pytest
from oracle_check import compare, connect

from ledgerline.plans.oracles import ORACLES
from ledgerline.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and set(e.oracle_sql()) <= set(e.queries())
