"""Every query against its SQL on an independent engine."""

import os
from functools import cache

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from marketlake.plans import queries as catalogue

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="module", autouse=True)
def shared_flows():
    """Queries over the tables of one flow share its run here."""
    with pytest.MonkeyPatch.context() as patch:
        for flow in ("_historical", "_daily", "_streamed"):
            patch.setattr(catalogue, flow, cache(getattr(catalogue, flow)))
        yield


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, duck, sql) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
