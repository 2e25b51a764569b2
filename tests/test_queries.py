"""Every registered query against its oracle SQL."""

import pytest

from millrace.compare import compare, oracle_connection
from millrace.plans import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def oracle(small):
    return oracle_connection(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, small, oracle, name):
    assert compare(QUERIES[name](spark, small), oracle, ORACLES.get(name)) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["o_orderpriority", "total_rev", "avg_rev"] and df.count() == 3
