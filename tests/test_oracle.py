import pytest
from oracle import assert_same, connect

from __spark_entry__ import oracle_sql, queries
from txrisk.plans import catalogue, catalogue_sql

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert_same(queries()[name](spark, SF_DIR), con, oracle_sql()[name])


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue_sql.ORACLES)
    assert set(oracle_sql()) <= set(queries())
