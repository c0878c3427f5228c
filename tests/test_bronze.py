from pyspark.sql import functions as F

from dwellmart.schemas import BRONZE_SCHEMA, ENVELOPE_SCHEMA, SALE_COLUMNS
from dwellmart.sources.surrogate import raw_sales
from dwellmart.sources.tables import read_table
from dwellmart.sources.topic import publish, stream_topic, to_envelopes
from dwellmart.streaming.bronze import bronze_rows, start_bronze
from dwellmart.streaming.triggers import trigger_for


def parsed(spark, *values):
    rows = [(b"key", None if v is None else v.encode(), "sales", 1, i, None) for i, v in enumerate(values)]
    return bronze_rows(spark.createDataFrame(rows, ENVELOPE_SCHEMA)).orderBy("_kafka_offset").collect()


def test_json_edge_cases(spark):
    valid, broken, unknown, number, nested, missing = parsed(
        spark, '{"County":"Cork"}', "not json", '{"Colour":"red"}', '{"County":5}', '{"County":{"a":1}}', None
    )
    assert valid.county == "Cork" and valid.address is None
    for row in (broken, unknown, missing):
        assert all(row[c] is None for c in SALE_COLUMNS)
        assert row._kafka_key == "key" and row._kafka_topic == "sales" and row._kafka_partition == 1
    assert number.county == "5" and nested.county == '{"a":1}'


def test_schema_is_the_declared_one(spark, sf_dir):
    frame = bronze_rows(to_envelopes(raw_sales(spark, sf_dir), "sales"))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in BRONZE_SCHEMA]


def test_json_is_parsed_once_per_row(spark, sf_dir):
    plan = bronze_rows(to_envelopes(raw_sales(spark, sf_dir), "sales"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_resume_reads_only_what_is_new(spark, folder, sf_dir):
    raw = raw_sales(spark, sf_dir, deliveries=1)
    n = raw.count()

    def ingest():
        envelopes = stream_topic(spark, f"{folder}/topic")
        start_bronze(envelopes, f"{folder}/bronze", f"{folder}/checkpoint").awaitTermination(120)
        return read_table(spark, f"{folder}/bronze", BRONZE_SCHEMA).count()

    publish(raw, f"{folder}/topic", "sales")
    assert ingest() == n
    assert ingest() == n
    publish(raw, f"{folder}/topic", "sales")
    assert ingest() == 2 * n


def test_one_ingestion_time_per_micro_batch(spark, folder, sf_dir):
    publish(raw_sales(spark, sf_dir, deliveries=1), f"{folder}/topic", "sales")
    envelopes = stream_topic(spark, f"{folder}/topic")
    start_bronze(envelopes, f"{folder}/bronze", f"{folder}/checkpoint").awaitTermination(120)
    bronze = read_table(spark, f"{folder}/bronze", BRONZE_SCHEMA)
    assert bronze.select(F.count_distinct("_ingested_at")).first()[0] == 1


def test_trigger_modes():
    assert trigger_for("once") == {"availableNow": True}
    assert trigger_for("continuous") == {"processingTime": "30 seconds"}
    assert trigger_for("steady", "5 seconds") == {"processingTime": "5 seconds"}


def test_periodic_mode_keeps_running(spark, folder, sf_dir):
    publish(raw_sales(spark, sf_dir, deliveries=1), f"{folder}/topic", "sales")
    envelopes = stream_topic(spark, f"{folder}/topic")
    query = start_bronze(envelopes, f"{folder}/bronze", f"{folder}/checkpoint", mode="steady", period="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert not read_table(spark, f"{folder}/bronze", BRONZE_SCHEMA).isEmpty()
