import pytest
from pyspark.errors import AnalysisException

from dwellmart.operators.checks import QualityError
from dwellmart.plans.pipeline import Store, mart_job, read_mart, run_pipeline, run_stages, stage_outcomes
from dwellmart.plans.registered import mart_of
from dwellmart.schemas import GOLD_SCHEMA, MART_SCHEMA
from dwellmart.sources.sales_csv import write_sales_csv
from dwellmart.sources.surrogate import raw_sales
from dwellmart.sources.tables import read_table, replace_table
from tests.comparison import spark_bag


def test_stages_give_the_mart_of_one_plan(spark, folder, sf_dir):
    csv = f"{folder}/csv"
    write_sales_csv(raw_sales(spark, sf_dir), csv)
    mart = run_pipeline(spark, csv, Store(f"{folder}/store", buckets=4), check=False)
    assert spark_bag(mart) == spark_bag(mart_of(spark, sf_dir))
    assert [(f.name, f.dataType) for f in mart.schema] == [(f.name, f.dataType) for f in MART_SCHEMA]


def test_running_again_adds_nothing(spark, folder, sf_dir):
    store = Store(folder, buckets=4)
    raw = raw_sales(spark, sf_dir, deliveries=1, spoiled=False)
    first = spark_bag(run_pipeline(spark, raw, store))
    again = spark_bag(run_pipeline(spark, raw, store))
    assert first == again
    assert spark.read.parquet(store.path("bronze")).count() == 2 * store.silver(spark).read(spark).count()


def test_the_check_runs_last_and_fails_the_run(spark, folder, sf_dir):
    store = Store(folder, buckets=4)
    with pytest.raises(QualityError, match="year"):
        run_pipeline(spark, raw_sales(spark, sf_dir, deliveries=1), store)
    assert read_mart(spark, store).where("year IS NULL").count() > 0


def test_tables_are_found_by_name(spark, folder, sf_dir):
    store = Store(folder, buckets=4, warehouse_name="warehouse_by_name", mart_name="mart_by_name")
    mart = spark_bag(run_pipeline(spark, raw_sales(spark, sf_dir, deliveries=1, spoiled=False), store))
    assert spark_bag(spark.table("mart_by_name")) == mart
    assert spark.table("warehouse_by_name").schema.names == GOLD_SCHEMA.names
    spark.sql("DROP TABLE warehouse_by_name")
    mart_job(spark, store)  # another session's catalog does not know the name yet
    assert spark_bag(spark.table("mart_by_name")) == mart
    with pytest.raises(AnalysisException):
        spark.read.parquet(store.path("gold_first_pass"))


def test_missing_input_fails_before_anything_is_written(spark, folder):
    with pytest.raises(AnalysisException):
        run_pipeline(spark, f"{folder}/absent.csv", Store(f"{folder}/store", buckets=4))
    with pytest.raises(AnalysisException):
        spark.read.parquet(f"{folder}/store/topic")


def test_replace_leaves_only_the_new_rows_and_counts_them(spark, folder):
    rows = spark.range(5).toDF("n")
    assert replace_table(rows, folder) == 5
    assert replace_table(rows.where("n < 2"), folder) == 2
    assert read_table(spark, folder, rows.schema).count() == 2


def test_replace_can_name_the_table(spark, folder, sf_dir):
    gold = spark.createDataFrame([], GOLD_SCHEMA)
    assert replace_table(gold, folder, name="warehouse_table_test") == 0
    assert spark.table("warehouse_table_test").schema.names == GOLD_SCHEMA.names
    spark.sql("DROP TABLE warehouse_table_test")


def test_outcomes_tell_what_became_of_each_stage(spark, folder):
    store = Store(folder)
    run_stages(spark, store, {"one": lambda: 1, "two": lambda: 2})

    def fails():
        raise KeyError("no such thing\nand more")

    with pytest.raises(KeyError):
        run_stages(spark, store, {"one": lambda: 5, "two": fails, "three": lambda: 3})
    rows = stage_outcomes(spark, store).orderBy("error", "position", "row_count").collect()
    by_run = {r.run_id: [(x.stage, x.row_count, x.error) for x in sorted(rows, key=lambda x: x.position) if x.run_id == r.run_id] for r in rows}
    assert sorted(by_run.values()) == [
        [("one", 1, None), ("two", 2, None)],
        [("one", 5, None), ("two", None, "KeyError: 'no such thing\\nand more'")],
    ]


def test_a_missing_file_is_an_outcome(spark, folder):
    store = Store(f"{folder}/store", buckets=4)
    with pytest.raises(AnalysisException):
        run_pipeline(spark, f"{folder}/absent.csv", store)
    row = stage_outcomes(spark, store).first()
    assert (row.position, row.stage, row.row_count) == (0, "publish", None) and "PATH_NOT_FOUND" in row.error
