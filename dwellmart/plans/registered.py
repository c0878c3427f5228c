"""The registered queries: each operator of the library on the sales made from the given tables.

Every query takes ``(spark, sf_dir)``, reads whole tables and returns a lazy DataFrame. Queries about
stored tables and streams first run their jobs in a new folder of the shared folder.
"""

import time
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmart.functions import cleaning
from dwellmart.operators import checks, selection
from dwellmart.operators.county_map import weighted_median_by_county, with_coordinates
from dwellmart.operators.first_copy import first_copy
from dwellmart.operators.insert_only import unseen_rows
from dwellmart.operators.price_summary import summarise_prices
from dwellmart.operators.prior_row import with_change, with_prior_median
from dwellmart.plans import panels
from dwellmart.plans.mart import build_mart, register_source, staging_view
from dwellmart.plans.pipeline import (
    Store,
    bronze_job,
    mart_job,
    publish_job,
    run_pipeline,
    silver_job,
    stage_outcomes,
    warehouse_job,
)
from dwellmart.schemas import BRONZE_SCHEMA, GOLD_SCHEMA, MART_SCHEMA, SALE_COLUMNS, SALE_KEY, SILVER_SCHEMA, SUMMARY_KEY
from dwellmart.session import discard, shared_folder
from dwellmart.sources.counties import county_coordinates
from dwellmart.sources.sales_csv import scan_sales_csv, write_sales_csv
from dwellmart.sources.surrogate import raw_sales
from dwellmart.sources.tables import read_table, replace_table, stream_table
from dwellmart.sources.topic import CLOCK, message_key, read_topic, stream_topic, to_envelopes
from dwellmart.streaming.bronze import bronze_rows, rename_headers
from dwellmart.streaming.silver import silver_rows, start_silver

TOPIC = "property_sales"
SELECTED_COUNTIES = ["Dublin", "Cork", "Galway", "Kerry"]
SELECTED_TYPES = ["1-URGENT Dwelling", "2-HIGH Dwelling", "5-LOW Dwelling"]
ABSENT_COUNTIES = ["Atlantis", "Avalon", "Lyonesse"]

#: Queries over sales whose dates and prices can all be read.
READABLE = [
    "export_casts", "price_summary_sorted", "headline_metrics", "trend_series", "map_dataset", "underlying_table",
    "end_to_end_run",
]

QUERIES = {}


def registered(query):
    QUERIES[query.__name__.removesuffix("_query")] = query
    return query


# --- inputs shared by the queries -------------------------------------------------------------------


def bronze_of(spark: SparkSession, sf: str, spoiled: bool = True) -> DataFrame:
    return rename_headers(raw_sales(spark, sf, spoiled=spoiled))


def silver_of(spark: SparkSession, sf: str, spoiled: bool = True) -> DataFrame:
    rows = silver_rows(bronze_of(spark, sf, spoiled))
    return first_copy(rows, SALE_KEY, [c for c in SALE_COLUMNS if c not in SALE_KEY])


def gold_of(spark: SparkSession, sf: str, spoiled: bool = True) -> DataFrame:
    return summarise_prices(silver_of(spark, sf, spoiled))


def mart_of(spark: SparkSession, sf: str, spoiled: bool = True) -> DataFrame:
    """The mart as users find it: stored."""
    path, workspace = shared_folder(spark, "mart"), shared_folder(spark, "middle-bins")
    gold = summarise_prices(silver_of(spark, sf, spoiled), workspace)
    replace_table(build_mart(spark, gold), path)
    discard(spark, workspace)
    return read_table(spark, path, MART_SCHEMA)


def served_of(spark: SparkSession, sf: str) -> DataFrame:
    return panels.price_summary(mart_of(spark, sf, spoiled=False))


def new_store(spark: SparkSession) -> Store:
    root = shared_folder(spark, "store")
    own = root[-12:]  # the catalog of a session is shared by all stores of that session
    return Store(root, TOPIC, 8, warehouse_name=f"price_summary_{own}", mart_name=f"property_prices_{own}")


def stored_sales(spark: SparkSession, store: Store) -> DataFrame:
    return store.silver(spark).read(spark).select(*SALE_COLUMNS)


def rounded(rows: DataFrame) -> DataFrame:
    """Sums of doubles depend on their order in the last digits.

    A median is a whole number of half cents, so three places show a sum in full.
    """
    places = {"_weighted_price_sum": 3, "weighted_median_price_eur": 6}
    return rows.withColumns({name: F.round(name, digits) for name, digits in places.items()})


# --- sources ----------------------------------------------------------------------------------------


@registered
def csv_scan(spark, sf):
    path = shared_folder(spark, "csv")
    write_sales_csv(raw_sales(spark, sf), path)
    return rename_headers(scan_sales_csv(spark, path))


@registered
def stream_envelope_source(spark, sf):
    store = new_store(spark)
    publish_job(raw_sales(spark, sf), store)
    messages = stream_topic(spark, store.path("topic")).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic"
    )
    _drain(messages, store.path("copy"), store.checkpoint("copy"))
    return spark.read.schema(messages.schema).parquet(store.path("copy"))


@registered
def stream_table_source(spark, sf):
    store = new_store(spark)
    publish_job(raw_sales(spark, sf), store)
    bronze_job(spark, store)
    rows = stream_table(spark, store.path("bronze"), BRONZE_SCHEMA).select(*SALE_COLUMNS)
    _drain(rows, store.path("copy"), store.checkpoint("copy"))
    return spark.read.schema(rows.schema).parquet(store.path("copy"))


def _drain(rows: DataFrame, path: str, checkpoint: str) -> None:
    stream = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start(path).awaitTermination()


@registered
def batch_scan(spark, sf):
    path = shared_folder(spark, "silver")
    replace_table(silver_of(spark, sf), path)
    stored = [f for f in SILVER_SCHEMA if f.name in SALE_COLUMNS]
    return read_table(spark, path, type(SILVER_SCHEMA)(stored)).select("county", "date_of_sale", "price_eur")


# --- publish and Bronze -----------------------------------------------------------------------------


@registered
def envelope_encode(spark, sf):
    return to_envelopes(raw_sales(spark, sf), TOPIC, partitions=8).select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        F.col("partition").between(0, 7).alias("partition_in_range"),
    )


@registered
def message_key_query(spark, sf):
    return raw_sales(spark, sf).select(message_key().alias("message_key"))


@registered
def json_parse(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    return events.select("event_id", F.from_json("props", "k string")["k"].alias("k"))


@registered
def header_rename(spark, sf):
    return rename_headers(raw_sales(spark, sf))


@registered
def bronze_parse(spark, sf):
    return _comparable_bronze(bronze_rows(to_envelopes(raw_sales(spark, sf), TOPIC)))


def _comparable_bronze(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        *SALE_COLUMNS,
        "_kafka_key",
        "_kafka_topic",
        F.col("_kafka_offset").isNotNull().alias("has_offset"),
        F.col("_ingested_at").isNotNull().alias("has_ingestion_time"),
    )


@registered
def bronze_append(spark, sf):
    store = new_store(spark)
    publish_job(raw_sales(spark, sf), store)
    bronze_job(spark, store)
    return _comparable_bronze(read_table(spark, store.path("bronze"), BRONZE_SCHEMA))


@registered
def stream_resume(spark, sf):
    """Publish, ingest, ingest again with nothing new, publish again, ingest the rest."""
    store = new_store(spark)
    once = raw_sales(spark, sf, deliveries=1)
    publish_job(once, store)
    bronze_job(spark, store)
    bronze_job(spark, store)
    publish_job(once, store)
    bronze_job(spark, store)
    return read_table(spark, store.path("bronze"), BRONZE_SCHEMA).select(*SALE_COLUMNS)


@registered
def message_positions(spark, sf):
    """Two publishes: no message shares topic, partition and offset with another, and later ones come after."""
    store = new_store(spark)
    once = raw_sales(spark, sf, deliveries=1)
    first, second = publish_job(once, store), publish_job(once, store)
    bronze_job(spark, store)
    bronze = read_table(spark, store.path("bronze"), BRONZE_SCHEMA)
    position = ["_kafka_topic", "_kafka_partition", "_kafka_offset"]
    publishes = F.when(F.col("_kafka_offset") <= first.last_offset, "first").otherwise("second")
    by_place = bronze.groupBy(*position, publishes.alias("publish")).agg(F.count("*").alias("n"))
    return by_place.groupBy("publish").agg(
        F.sum("n").alias("messages"), F.count("*").alias("positions"),
        (F.max("_kafka_offset") <= second.last_offset).alias("in_order"),
    )


@registered
def stream_start_position(spark, sf):
    """A fresh checkpoint that begins with the second of two publishes."""
    store = new_store(spark)
    once = raw_sales(spark, sf, deliveries=1)
    publish_job(once, store)
    last = read_topic(spark, store.topic).agg(F.max("timestamp") + F.expr("INTERVAL 1 MICROSECOND")).first()[0]
    publish_job(once, store)
    bronze_job(spark, replace(store, topic_start=str(last)))
    return read_table(spark, store.path("bronze"), BRONZE_SCHEMA).select(*SALE_COLUMNS)


@registered
def periodic_trigger(spark, sf):
    """A periodic stream over two publishes, one at a time, that ends itself when nothing new is found.

    The stream takes as many files in a batch as the first publish has, the oldest first. The second has no more than
    that, and all of its files are later, also where times are kept in whole seconds.
    """
    store = new_store(spark)
    once = raw_sales(spark, sf, deliveries=1)
    publish_job(once, store)
    files = len(read_topic(spark, store.topic).inputFiles())
    time.sleep(CLOCK.total_seconds())
    publish_job(once.coalesce(files), store)
    paced = replace(store, topic_options={"maxFilesPerTrigger": files})
    batches = bronze_job(spark, paced, "until_idle", "1 second")
    rows = [(batch.batch_id, batch.read) for batch in batches]
    return spark.createDataFrame(rows, "batch bigint, rows_read bigint")


@registered
def stream_row_counts(spark, sf):
    """What the streaming jobs count when the same file comes twice."""
    store = new_store(spark)
    once, counts = raw_sales(spark, sf, deliveries=1), []
    for delivery in (1, 2):
        publish_job(once, store)
        for stage, job in (("bronze", bronze_job), ("silver", silver_job)):
            for batch in job(spark, store):
                counts.append((stage, delivery, batch.read, batch.first_copies, batch.inserted))
    return spark.createDataFrame(counts, "stage string, delivery int, read bigint, first_copies bigint, inserted bigint")


# --- Silver -----------------------------------------------------------------------------------------


@registered
def parse_date(spark, sf):
    return bronze_of(spark, sf).select(
        "date_of_sale", cleaning.sale_date(F.col("date_of_sale")).alias("sale_date")
    )


@registered
def parse_price(spark, sf):
    text = F.col("price_eur")
    return bronze_of(spark, sf).select(
        text.alias("price_text"), cleaning.price_digits(text).alias("digits"), cleaning.price(text).alias("price")
    )


@registered
def normalize_text(spark, sf):
    columns = ["address", "county", "description_of_property", "property_size_description"]
    return bronze_of(spark, sf).select(*(cleaning.tidy_spaces(F.col(c)).alias(c) for c in columns))


@registered
def flag_normalize(spark, sf):
    columns = ["not_full_market_price", "vat_exclusive"]
    return bronze_of(spark, sf).select("eircode", *(cleaning.yes_flag(F.col(c)).alias(c) for c in columns))


@registered
def silver_transform(spark, sf):
    return silver_rows(bronze_of(spark, sf))


@registered
def dedup_natural_key(spark, sf):
    return silver_of(spark, sf)


@registered
def anti_join_new_rows(spark, sf):
    sales = silver_of(spark, sf)
    return unseen_rows(sales, sales.where(~F.col("vat_exclusive")), SALE_KEY)


@registered
def upsert_first_batch(spark, sf):
    store = new_store(spark)
    publish_job(raw_sales(spark, sf), store)
    bronze_job(spark, store)
    silver_job(spark, store)
    return stored_sales(spark, store)


@registered
def silver_upsert(spark, sf):
    """The file is sent again after its first delivery has reached Silver."""
    store = new_store(spark)
    once = raw_sales(spark, sf, deliveries=1)
    for _ in range(2):
        publish_job(once, store)
        bronze_job(spark, store)
        silver_job(spark, store)
    return stored_sales(spark, store)


@registered
def replay_dedup(spark, sf):
    """A new checkpoint makes Silver read all of Bronze again."""
    store = new_store(spark)
    publish_job(raw_sales(spark, sf), store)
    bronze_job(spark, store)
    silver_job(spark, store)
    bronze = stream_table(spark, store.path("bronze"), BRONZE_SCHEMA)
    start_silver(bronze, store.silver(spark), store.checkpoint("silver-again")).awaitTermination()
    return stored_sales(spark, store)


# --- Gold -------------------------------------------------------------------------------------------


@registered
def extract_year(spark, sf):
    return silver_of(spark, sf).select("date_of_sale", F.year("date_of_sale").alias("year"))


@registered
def gold_summary(spark, sf):
    return gold_of(spark, sf)


@registered
def agg_count(spark, sf):
    return gold_of(spark, sf).select(*SUMMARY_KEY, "transaction_count")


@registered
def agg_avg(spark, sf):
    return gold_of(spark, sf).select(*SUMMARY_KEY, "avg_price_eur")


@registered
def agg_median(spark, sf):
    return gold_of(spark, sf).select(*SUMMARY_KEY, "median_price_eur")


@registered
def agg_min_max(spark, sf):
    return gold_of(spark, sf).select(*SUMMARY_KEY, "min_price_eur", "max_price_eur")


@registered
def gold_overwrite(spark, sf):
    path = shared_folder(spark, "gold")
    replace_table(gold_of(spark, sf), path)
    replace_table(gold_of(spark, sf), path)
    return read_table(spark, path, GOLD_SCHEMA)


@registered
def table_reload(spark, sf):
    """What readers of a replaced table see: one that opened it before the load, one after it and after a failed one."""
    store = new_store(spark)
    gold, path = gold_of(spark, sf), store.path("gold")
    replace_table(gold, path, store.warehouse_name)
    before = read_table(spark, path, GOLD_SCHEMA)
    replace_table(read_table(spark, path, GOLD_SCHEMA).where("year >= 1995"), path, store.warehouse_name)
    broken = read_table(spark, path, GOLD_SCHEMA).withColumn("county", F.raise_error(F.lit("broken load")).cast("string"))
    try:
        replace_table(broken, path, store.warehouse_name)
    except Exception as failure:
        if "broken load" not in str(failure):
            raise
    readers = {"before": before, "after": read_table(spark, path, GOLD_SCHEMA), "by_name": spark.table(store.warehouse_name)}
    sums = [
        rows.agg(F.count("*").alias("row_count"), F.sum("transaction_count").alias("sales")).select(F.lit(name).alias("reader"), "*")
        for name, rows in readers.items()
    ]
    return reduce(DataFrame.unionByName, sums)


# --- warehouse, staging, mart -----------------------------------------------------------------------


@registered
def warehouse_load(spark, sf):
    store = new_store(spark)
    replace_table(gold_of(spark, sf), store.path("gold"))
    warehouse_job(spark, store)
    return spark.table(store.warehouse_name)


@registered
def job_row_counts(spark, sf):
    store = new_store(spark)
    outcome = publish_job(raw_sales(spark, sf), store)
    gold = replace_table(gold_of(spark, sf), store.path("gold"))
    loaded = warehouse_job(spark, store)
    counts = {"sent": outcome.sent, "failed": outcome.failed, "gold_written": gold, "warehouse_loaded": loaded}
    return spark.createDataFrame(list(counts.items()), "counter string, row_count bigint")


def _staged(spark, sf):
    register_source(gold_of(spark, sf))
    return staging_view(spark)


@registered
def staging_view_query(spark, sf):
    return _staged(spark, sf)


@registered
def lag_prior_year(spark, sf):
    return with_prior_median(_staged(spark, sf)).select(
        "county", "property_type", "year", "median_price_eur", "prior_median_eur"
    )


@registered
def yoy_change(spark, sf):
    return with_change(with_prior_median(_staged(spark, sf))).select(
        "county", "property_type", "year", "median_price_change_eur", "median_price_change_pct"
    )


@registered
def mart_summary(spark, sf):
    store = new_store(spark)
    replace_table(gold_of(spark, sf), store.path("gold"))
    warehouse_job(spark, store)
    mart_job(spark, store)
    return spark.table(store.mart_name)


@registered
def dq_not_null(spark, sf):
    return checks.null_counts(mart_of(spark, sf))


@registered
def export_casts(spark, sf):
    return checks.export_types(mart_of(spark, sf, spoiled=False))


# --- panels -----------------------------------------------------------------------------------------


@registered
def price_summary_sorted(spark, sf):
    return served_of(spark, sf)


@registered
def distinct_filters(spark, sf):
    return selection.choices(mart_of(spark, sf), "county")


@registered
def distinct_property_types(spark, sf):
    return selection.choices(mart_of(spark, sf), "property_type")


@registered
def default_selection(spark, sf):
    return selection.default_counties(mart_of(spark, sf))


@registered
def default_selection_fallback(spark, sf):
    return selection.default_counties(mart_of(spark, sf), ABSENT_COUNTIES)


@registered
def filter_isin(spark, sf):
    return selection.choose(mart_of(spark, sf), SELECTED_COUNTIES, SELECTED_TYPES)


@registered
def latest_year(spark, sf):
    return selection.at_latest_year(selection.choose(mart_of(spark, sf), SELECTED_COUNTIES, SELECTED_TYPES))


@registered
def headline_metrics(spark, sf):
    return panels.headline_metrics(served_of(spark, sf), ["Dublin"])


@registered
def trend_series(spark, sf):
    return panels.trend_series(served_of(spark, sf), SELECTED_COUNTIES)


@registered
def weighted_median_by_county_query(spark, sf):
    sums = weighted_median_by_county(mart_of(spark, sf))
    return rounded(sums)


@registered
def geo_lookup(spark, sf):
    placed = with_coordinates(weighted_median_by_county(mart_of(spark, sf)), county_coordinates(spark))
    return placed.select("county", "total_transactions", "lat", "lon")


@registered
def map_dataset(spark, sf):
    placed = panels.map_dataset(served_of(spark, sf), property_types=SELECTED_TYPES)
    return rounded(placed)


@registered
def underlying_table(spark, sf):
    return panels.underlying_table(served_of(spark, sf), SELECTED_COUNTIES, SELECTED_TYPES)


# --- all stages -------------------------------------------------------------------------------------


@registered
def end_to_end_run(spark, sf):
    """CSV files to mart and its check, over all orders with dates and prices that can be read."""
    path = shared_folder(spark, "csv")
    write_sales_csv(raw_sales(spark, sf, spoiled=False), path)
    return run_pipeline(spark, path, new_store(spark))


@registered
def stage_outcomes_query(spark, sf):
    """What is written down of a run over spoiled sales, which its check ends."""
    store = new_store(spark)
    try:
        run_pipeline(spark, raw_sales(spark, sf), store)
    except checks.QualityError:
        pass
    return stage_outcomes(spark, store).select(
        "position", "stage", "row_count", F.regexp_extract("error", r"^\w+", 0).alias("error")
    )


@registered
def empty_choice(spark, sf):
    """Which panels answer a choice: one with rows, and one without."""
    served = served_of(spark, sf)
    answers = []
    for choice, counties in (("some", SELECTED_COUNTIES), ("none", ABSENT_COUNTIES)):
        for name, panel in (("trend", panels.trend_series), ("map", panels.map_dataset), ("table", panels.underlying_table)):
            try:
                found = panel(served, counties).agg(F.count("*")).first()[0] > 0
            except Exception as failure:
                if selection.NOTHING_CHOSEN not in str(failure):
                    raise
                found = False
            answers.append((choice, name, found))
    return spark.createDataFrame(answers, "choice string, panel string, has_rows boolean")
