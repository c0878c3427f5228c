"""The stages as jobs, and all of them in order."""

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from dwellmart.operators.checks import require_filled
from dwellmart.operators.price_summary import summarise_prices
from dwellmart.plans.mart import mart_rows, staging_view
from dwellmart.schemas import BRONZE_SCHEMA, GOLD_SCHEMA, MART_SCHEMA
from dwellmart.session import discard
from dwellmart.sources.sales_csv import scan_sales_csv
from dwellmart.sources.tables import name_table, read_table, replace_table, stream_table
from dwellmart.sources.topic import Published, publish, stream_topic
from dwellmart.streaming.bronze import start_bronze
from dwellmart.streaming.counters import BatchCounts, run_counted
from dwellmart.streaming.silver import SilverTable, start_silver
from dwellmart.streaming.triggers import PERIOD

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Store:
    """Where the tables and stream positions of one pipeline are kept. ``root`` is a shared folder."""

    root: str
    topic_name: str = "property_sales"
    # Buckets of the Silver table; needed when the first batch makes it.
    buckets: int | None = None
    # Bounds on a micro-batch of the Silver stream. The rows do not depend on them.
    read_options: dict = field(default_factory=lambda: {"maxFilesPerTrigger": 1000})
    # "kafka" with its connection options, where that package is installed.
    topic_format: str = "parquet"
    topic_options: dict = field(default_factory=dict)
    # Time of the first message that a fresh Bronze checkpoint takes in; None for all there are.
    topic_start: str | None = None
    # Names that the catalog knows the warehouse table and the mart by.
    warehouse_name: str = "county_yearly_price_summary"
    mart_name: str = "property_price_summary"

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    @property
    def topic(self) -> str:
        return self.topic_name if self.topic_format == "kafka" else self.path("topic")

    def checkpoint(self, stage: str) -> str:
        return self.path(f"checkpoints/{stage}")

    def silver(self, spark: SparkSession) -> SilverTable:
        return SilverTable(spark, self.path("silver"), self.buckets)


def publish_job(raw: DataFrame, store: Store) -> Published:
    outcome = publish(
        raw, store.topic, store.topic_name, format=store.topic_format, **_connection(store.topic_options)
    )
    logger.info("published %d rows, %d failed", outcome.sent, outcome.failed)
    return outcome


def _connection(options: dict) -> dict:
    """The options a writer shares with a reader: where the brokers are, not how much to read."""
    return {name: value for name, value in options.items() if name.startswith("kafka.")}


def bronze_job(spark: SparkSession, store: Store, mode: str = "once", period: str = PERIOD) -> list[BatchCounts]:
    """Take in new messages and return the counts of each batch.

    In mode ``until_idle`` a periodic stream ends itself when a trigger has found nothing new; in any other mode
    but ``once`` this runs until it is stopped.
    """
    envelopes = stream_topic(spark, store.topic, store.topic_format, store.topic_start, **store.topic_options)
    batches = run_counted(
        spark,
        lambda: start_bronze(envelopes, store.path("bronze"), store.checkpoint("bronze"), mode, period),
        until_idle=mode == "until_idle",
    )
    logger.info("took in %d messages in %d batches", sum(b.read for b in batches), len(batches))
    return batches


def silver_job(spark: SparkSession, store: Store) -> list[BatchCounts]:
    """Upsert what Bronze has got, and return the counts of each batch."""
    batches: list[BatchCounts] = []
    bronze = stream_table(spark, store.path("bronze"), BRONZE_SCHEMA, **store.read_options)
    start_silver(bronze, store.silver(spark), store.checkpoint("silver"), counts=batches).awaitTermination()
    for batch in batches:
        logger.info("batch %d: %d rows, %d sales, %d new", batch.batch_id, batch.read, batch.first_copies, batch.inserted)
    return batches


def gold_job(spark: SparkSession, store: Store) -> int:
    """Recompute the summary from all of Silver and replace the stored one."""
    workspace = store.path("gold_first_pass")
    rows = replace_table(summarise_prices(store.silver(spark).read(spark), workspace), store.path("gold"))
    discard(spark, workspace)
    return rows


def warehouse_job(spark: SparkSession, store: Store) -> int:
    """Copy the summary to the warehouse table, replacing it."""
    gold = read_table(spark, store.path("gold"), GOLD_SCHEMA)
    rows = replace_table(gold, store.path("warehouse"), store.warehouse_name)
    logger.info("loaded %d rows into the warehouse table", rows)
    return rows


def mart_job(spark: SparkSession, store: Store) -> int:
    """Staging view over the named warehouse table, and the named mart table."""
    name_table(spark, store.warehouse_name, store.path("warehouse"), GOLD_SCHEMA)
    mart = mart_rows(staging_view(spark, store.warehouse_name))
    return replace_table(mart, store.path("mart"), store.mart_name)


def check_job(spark: SparkSession, store: Store) -> None:
    """Fail if a required column of the mart holds NULLs."""
    require_filled(read_mart(spark, store))


def read_mart(spark: SparkSession, store: Store) -> DataFrame:
    return read_table(spark, store.path("mart"), MART_SCHEMA)


OUTCOME_SCHEMA = "run_id string, position int, stage string, row_count bigint, error string"


def stage_outcomes(spark: SparkSession, store: Store) -> DataFrame:
    """What became of the stages of all runs: rows, or the error of the stage that ended a run."""
    return spark.read.schema(OUTCOME_SCHEMA).json(store.path("outcomes"))


def run_stages(spark: SparkSession, store: Store, stages: dict[str, Callable[[], int]]) -> None:
    """Run stages in their order and write down what became of each, also of the one that fails.

    A stage gives its number of rows. One that fails raises, and later ones do not run.
    """
    outcomes, run_id = [], uuid.uuid4().hex
    try:
        for position, (stage, job) in enumerate(stages.items()):
            try:
                outcomes.append((run_id, position, stage, job(), None))
            except Exception as failure:
                outcomes.append((run_id, position, stage, None, f"{type(failure).__name__}: {failure}".splitlines()[0]))
                raise
    finally:
        written = spark.createDataFrame(outcomes, OUTCOME_SCHEMA).coalesce(1).write.option("ignoreNullFields", False)
        written.mode("append").json(store.path("outcomes"))


def run_pipeline(
    spark: SparkSession, sales: str | DataFrame, store: Store, check: bool = True, parser: str = "auto"
) -> DataFrame:
    """Publish, ingest, clean, summarise, load, build the mart and check it, in this order.

    ``sales`` is a CSV path, read with ``parser``, or raw rows. A stage that fails raises and later stages do not run;
    ``stage_outcomes`` tells which one and why. Running again on the same store re-publishes and adds only
    sales that are new.
    """

    def publish_stage() -> int:
        raw = scan_sales_csv(spark, sales, parser) if isinstance(sales, str) else sales
        return publish_job(raw, store).sent

    def check_stage() -> int:
        check_job(spark, store)
        return read_mart(spark, store).count()

    stages = {
        "publish": publish_stage,
        "bronze": lambda: sum(batch.read for batch in bronze_job(spark, store)),
        "silver": lambda: sum(batch.inserted for batch in silver_job(spark, store)),
        "gold": lambda: gold_job(spark, store),
        "warehouse": lambda: warehouse_job(spark, store),
        "mart": lambda: mart_job(spark, store),
    }
    run_stages(spark, store, {**stages, "check": check_stage} if check else stages)
    return read_mart(spark, store)
