"""The registered queries against their SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry_module
from trendframe.plans.queries import QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    n, m, extra, missing = compare(
        spark, con, entry_module.queries()[name], entry_module.oracle_sql()[name], SF
    )
    assert (extra, missing) == ([], []) and n == m > 0


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[:2] == ["stage", "period"] and df.count() > 0
