"""Every query beside its SQL twin on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_trained_query_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_rows_and_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["split", "model", "users", "recall", "ndcg", "coverage"]
    assert df.count() == 6
