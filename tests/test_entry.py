import pytest

import __spark_entry__ as entry_point
from oracle_compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() >= 0


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["appid"]
