import pytest
from pyspark.sql import functions as F

from dwellmart.schemas import BRONZE_SCHEMA
from dwellmart.sources.surrogate import raw_sales
from dwellmart.sources.tables import read_table
from dwellmart.sources.topic import publish, stream_topic
from dwellmart.streaming.bronze import start_bronze
from dwellmart.streaming.counters import run_counted


def bronze(spark, folder, mode="once", rows=None, **options):
    envelopes = stream_topic(spark, f"{folder}/topic", **options)
    if rows is not None:
        envelopes = envelopes.withColumn("value", rows)
    return start_bronze(envelopes, f"{folder}/bronze", f"{folder}/checkpoint", mode, "1 second")


def test_each_batch_is_counted_and_an_empty_run_has_none(spark, folder, sf_dir):
    rows = raw_sales(spark, sf_dir, deliveries=1).repartition(3)
    publish(rows, f"{folder}/topic", "sales")
    batches = run_counted(spark, lambda: bronze(spark, folder, maxFilesPerTrigger=1))
    assert [b.batch_id for b in batches] == [0, 1, 2]
    assert sum(b.read for b in batches) == rows.count()
    assert run_counted(spark, lambda: bronze(spark, folder)) == []


def test_a_periodic_stream_ends_when_nothing_is_new(spark, folder, sf_dir):
    rows = raw_sales(spark, sf_dir, deliveries=1).coalesce(1)
    for _ in range(2):
        publish(rows, f"{folder}/topic", "sales")
    batches = run_counted(spark, lambda: bronze(spark, folder, "steady", maxFilesPerTrigger=1), until_idle=True)
    assert [b.read for b in batches] == [rows.count()] * 2
    assert read_table(spark, f"{folder}/bronze", BRONZE_SCHEMA).count() == 2 * rows.count()
    assert not spark.streams.active


@pytest.mark.parametrize("until_idle", [False, True])
def test_a_stream_that_fails_raises(spark, folder, sf_dir, until_idle):
    publish(raw_sales(spark, sf_dir, deliveries=1), f"{folder}/topic", "sales")
    broken = F.raise_error(F.lit("broken message")).cast("binary")
    with pytest.raises(Exception, match="broken message"):
        run_counted(spark, lambda: bronze(spark, folder, "steady" if until_idle else "once", broken), until_idle)
