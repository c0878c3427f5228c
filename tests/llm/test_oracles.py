"""The registered queries of this subpackage that SQL can express, against their SQL."""

import pytest

from dwellmart.llm.queries import ORACLES, QUERIES
from tests.comparison import duckdb_bag, duckdb_on, spark_bag


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duckdb_on(sf_dir)


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    assert spark_bag(QUERIES[name](spark, sf_dir)) == duckdb_bag(connection, ORACLES[name])
