"""Every query against its SQL twin; those without one must give rows."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(base):
    return connect(base)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, base, con, name):
    assert compare(QUERIES[name](spark, base), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(spark, base, name):
    assert QUERIES[name](spark, base).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["enterprise_id", "date"] and df.count() > 0


def test_oracle_keys_are_queries():
    assert set(ORACLE) <= set(QUERIES)
