"""Every registered query against its SQL statement."""

import pytest
from compare import connect, difference
from conftest import SF_DIR

from haatlake.plans.registry import QUERIES
from oracle.queries import ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_entry_point(spark):
    import __spark_entry__ as e

    out = e.entry(spark)
    assert out.columns == ["year", "revenue_inr", "revenue_cr", "yoy_pct"] and out.count() == 7
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
