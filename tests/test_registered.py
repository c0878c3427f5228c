"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as driver
from dwellmart.plans import registered
from dwellmart.plans.oracles import ORACLES
from dwellmart.plans.registered import QUERIES
from tests.comparison import duckdb_bag, duckdb_on, spark_bag


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duckdb_on(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    result = driver.queries()[name](spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for banned in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan
    columns, rows = spark_bag(result)
    assert (columns, rows) == duckdb_bag(connection, driver.oracle_sql()[name])
    assert rows


def test_a_periodic_batch_is_a_publish_of_many_tasks(spark, folder, monkeypatch):
    orders = spark.range(50).selectExpr(
        "id AS o_orderkey", "id % 3 AS o_custkey", "'P' AS o_orderstatus", "1.5D AS o_totalprice",
        "DATE'1995-01-01' AS o_orderdate", "'5-LOW' AS o_orderpriority",
    )
    orders.repartition(5).write.parquet(f"{folder}/orders.parquet")
    spark.range(3).selectExpr("id AS c_custkey", "0 AS c_nationkey").write.parquet(f"{folder}/customer.parquet")
    spark.range(1).selectExpr("0 AS n_nationkey").write.parquet(f"{folder}/nation.parquet")
    stores, new_store = [], registered.new_store
    monkeypatch.setattr(registered, "new_store", lambda spark: stores.append(new_store(spark)) or stores[-1])
    batches = QUERIES["periodic_trigger"](spark, folder).collect()
    assert sorted(map(tuple, batches)) == [(0, 50), (1, 50)]
    files = spark.read.parquet(stores[0].topic).groupBy("_metadata.file_path").count().collect()
    assert len(files) > 2 and max(f["count"] for f in files) < 50


def test_entry(spark):
    assert driver.entry(spark).count() > 0
