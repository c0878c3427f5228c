import pytest
from pyspark.sql import functions as F

from dwellmart.sources.tables import current_folder, loads, name_table, read_table, replace_table

NAME = "reloaded_table_test"


@pytest.fixture
def named(spark):
    yield NAME
    spark.sql(f"DROP TABLE IF EXISTS {NAME}")


def values(frame):
    return sorted(r.n for r in frame.collect())


def test_readers_keep_the_load_they_opened(spark, folder, named):
    rows = spark.range(5).toDF("n")
    assert replace_table(rows, folder, named) == 5
    by_path, by_name = read_table(spark, folder, rows.schema), spark.table(named)
    assert replace_table(rows.where("n > 2"), folder, named) == 2
    assert values(by_path) == values(by_name) == [0, 1, 2, 3, 4]
    assert values(read_table(spark, folder, rows.schema)) == values(spark.table(named)) == [3, 4]


def test_a_failed_load_changes_nothing(spark, folder, named):
    rows = spark.range(50).toDF("n")
    replace_table(rows, folder, named)
    broken = rows.repartition(4).withColumn("n", F.when(F.col("n") == 33, F.raise_error(F.lit("broken"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="broken"):
        replace_table(broken, folder, named)
    assert values(read_table(spark, folder, rows.schema)) == values(spark.table(named)) == list(range(50))
    assert replace_table(rows.where("n = 7"), folder, named) == 1
    assert values(spark.table(named)) == [7]


def test_a_table_may_be_made_from_itself(spark, folder):
    rows = spark.range(5).toDF("n")
    replace_table(rows, folder)
    assert replace_table(read_table(spark, folder, rows.schema).where("n < 2"), folder) == 2
    assert values(read_table(spark, folder, rows.schema)) == [0, 1]


def test_only_the_last_two_loads_are_kept(spark, folder):
    for n in range(12):
        replace_table(spark.range(n).toDF("n"), folder)
    kept = loads(spark, folder)
    assert [name.rpartition("load-")[2][:9] for name in kept] == ["000000010", "000000011"]
    assert current_folder(spark, folder) == kept[-1]


def test_another_catalog_is_pointed_at_the_latest_load(spark, folder, named):
    rows = spark.range(3).toDF("n")
    replace_table(rows, folder)
    name_table(spark, named, folder, rows.schema)
    replace_table(rows.where("n = 1"), folder)  # by a session that does not know the name
    name_table(spark, named, folder, rows.schema)
    assert values(spark.table(named)) == [1]


def test_a_plain_folder_is_read_as_it_is(spark, folder):
    spark.range(3).toDF("n").write.parquet(folder)
    assert current_folder(spark, folder) == folder
    assert values(read_table(spark, folder, spark.range(1).toDF("n").schema)) == [0, 1, 2]
