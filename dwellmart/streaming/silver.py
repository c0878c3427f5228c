"""Silver: typed and tidied sales, each natural key inserted once.

The table is bucketed by the natural key. The upsert looks the keys of every batch up in the whole table, and
the bucketing means that the look-up moves only these keys: the table side of the join is read in place.

Files lie under ``query_id=.../batch_id=.../sale_year=...``. A batch that is delivered again replaces its own
partitions, so a crash between writing and committing leaves no second copy, NULL keys included. The query
id keeps a new checkpoint, whose batches count from 0 again, from replacing older batches. The year of the
sale lets the look-up pass by all partitions of years of which the batch has no sale. One writer at a time is
assumed.
"""

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dwellmart.functions import cleaning
from dwellmart.operators.first_copy import first_copy
from dwellmart.operators.insert_only import rows_of_keys, unseen_rows
from dwellmart.schemas import ARRIVAL_ORDER, SALE_KEY, SILVER_SCHEMA
from dwellmart.session import discard, session_conf, shared_folder
from dwellmart.sources.tables import if_present
from dwellmart.streaming.counters import BatchCounts
from dwellmart.streaming.triggers import PERIOD, trigger_for

BATCH_COLUMNS = ["query_id", "batch_id"]
YEAR = "sale_year"
#: So many new keys of a batch are few: they are sent to all tasks, and only their rows are moved.
FEW_KEYS = 100_000
_LAYOUT = "buckets int"


def silver_rows(bronze: DataFrame) -> DataFrame:
    """Bronze text -> typed columns. Other columns, lineage among them, pass through."""
    typed = {
        "date_of_sale": cleaning.sale_date,
        "price_eur": cleaning.price,
        "not_full_market_price": cleaning.yes_flag,
        "vat_exclusive": cleaning.yes_flag,
        "address": cleaning.tidy_spaces,
        "county": cleaning.tidy_spaces,
        "description_of_property": cleaning.tidy_spaces,
        "property_size_description": cleaning.tidy_spaces,
    }
    return bronze.withColumns({name: clean(F.col(name)) for name, clean in typed.items()})


class SilverTable:
    """The stored Silver table at ``path``.

    ``buckets`` is fixed by the first batch (later values are ignored) and must be given for it: choose it so
    that a bucket's share of one large batch is a few hundred MB. 64 suits the register itself, a 100 TB
    table wants thousands; ``rewrite`` moves a table to another number. Reading writes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, null_safe: bool = False):
        self.data = f"{path.rstrip('/')}/data"
        self.layout = f"{path.rstrip('/')}/layout"
        self.name = f"silver_{hashlib.sha256(self.data.encode()).hexdigest()[:16]}"
        self.null_safe = null_safe
        layout = if_present(lambda: spark.read.schema(_LAYOUT).json(self.layout))
        self.settled = layout is not None
        self.buckets = layout.first().buckets if layout is not None else buckets

    def _settle(self, spark: SparkSession) -> None:
        """Write the number of buckets down, once."""
        if self.settled:
            return
        layout = if_present(lambda: spark.read.schema(_LAYOUT).json(self.layout))
        if layout is not None:
            self.buckets = layout.first().buckets
        elif self.buckets is None:
            raise ValueError("a new Silver table needs a number of buckets")
        else:
            spark.createDataFrame([(self.buckets,)], _LAYOUT).coalesce(1).write.json(self.layout)
        self.settled = True

    def attach(self, spark: SparkSession) -> None:
        """Make the table known to the catalog, creating it if absent, with the batches it holds now.

        Other sessions may have written batches since this one looked, so it looks every time.
        """
        self._settle(spark)
        if not spark.catalog.tableExists(self.name):
            self._create(spark)
        if if_present(lambda: self.read(spark)) is not None:
            spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")
            spark.catalog.refreshTable(self.name)

    def _create(self, spark: SparkSession) -> None:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SILVER_SCHEMA)
        spark.sql(
            f"CREATE TABLE {self.name} ({fields}, query_id string, batch_id bigint, {YEAR} int) USING parquet "
            f"PARTITIONED BY ({', '.join(BATCH_COLUMNS)}, {YEAR}) "
            f"CLUSTERED BY ({', '.join(SALE_KEY)}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.data}'"
        )

    def read(self, spark: SparkSession) -> DataFrame:
        """The sales, without the columns of the file layout."""
        return spark.read.schema(SILVER_SCHEMA).parquet(self.data).select(*SILVER_SCHEMA.names)

    def upsert(self, batch: DataFrame, query_id: str, batch_id: int) -> BatchCounts:
        """Insert the rows of a batch whose natural key no other batch has brought, and count them on the way.

        Only keys are looked up: the different keys of the batch are stored in the shared folder, and of them
        those that the table lacks. The whole rows are read again for these alone. Where they are few, as
        when a register is sent again, no other row is moved or sorted.
        """
        spark = batch.sparkSession
        self._settle(spark)
        settings = {
            # Shuffles of the batch follow the buckets of the table, so that the table stays in place.
            "spark.sql.shuffle.partitions": str(self.buckets),
            "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "false",
            "spark.sql.sources.partitionOverwriteMode": "dynamic",
        }
        with session_conf(spark, settings):
            self.attach(spark)
            own = (F.col("query_id") == query_id) & (F.col("batch_id") == batch_id)
            others = spark.table(self.name).where(~own)
            read = Observation("read")
            if others.isEmpty():
                fresh = first_copy(counted(batch, read), SALE_KEY, ARRIVAL_ORDER)
                inserted = self._replace_batch(fresh, query_id, batch_id)
                return BatchCounts(batch_id, read.get["rows"], inserted, inserted)
            workspace = shared_folder(spark, "keys")
            different, unknown = Observation("different"), Observation("unknown")
            keys = counted(counted(batch.select(*SALE_KEY), read).distinct(), different)
            keys.write.parquet(f"{workspace}/all")
            keys = spark.read.schema(keys.schema).parquet(f"{workspace}/all")
            counted(self.unseen(keys, others), unknown).write.parquet(f"{workspace}/unseen")
            unseen = spark.read.schema(keys.schema).parquet(f"{workspace}/unseen")
            if unknown.get["rows"] <= FEW_KEYS:
                fresh = first_copy(rows_of_keys(batch, F.broadcast(unseen), SALE_KEY), SALE_KEY, ARRIVAL_ORDER)
            else:
                fresh = rows_of_keys(first_copy(batch, SALE_KEY, ARRIVAL_ORDER), unseen, SALE_KEY)
            inserted = self._replace_batch(fresh, query_id, batch_id)
            discard(spark, workspace)
            return BatchCounts(batch_id, read.get["rows"], different.get["rows"], inserted)

    def unseen(self, fresh: DataFrame, others: DataFrame) -> DataFrame:
        """Rows of a stored batch, with distinct keys, that the table lacks.

        A NULL date matches nothing, so only partitions of the batch's own years are read, and of them only
        row groups with dates between its first and last.
        """
        date = F.col("date_of_sale")
        # A calendar year each: a few dozen of them, never more than 10,000.
        looks = fresh.agg(F.min(date), F.max(date), F.collect_set(F.year(date))).first()
        first, last, years = looks
        same = F.col(YEAR).isin(years) & date.between(F.lit(first), F.lit(last)) if years else F.lit(False)
        if self.null_safe:
            same = same | F.col(YEAR).isNull()
        return unseen_rows(fresh, others.where(same), SALE_KEY, self.null_safe)

    def rewrite(self, spark: SparkSession, target: "SilverTable") -> None:
        """Copy the table to a new one: fewer and larger files, or another number of buckets.

        The latest batch of each query keeps its ids, since it is the one that may be delivered again; all
        earlier ones become one batch. Run it while nothing writes, then use the new table.
        """
        target._settle(spark)
        with session_conf(
            spark,
            {"spark.sql.shuffle.partitions": str(target.buckets), "spark.sql.sources.partitionOverwriteMode": "dynamic"},
        ):
            self.attach(spark)
            target.attach(spark)
            rows = spark.table(self.name)
            latest = rows.groupBy("query_id").agg(F.max("batch_id").alias("latest"))
            marked = rows.join(F.broadcast(latest), "query_id")
            open_batch = F.col("batch_id") == F.col("latest")
            # One row per query in `latest`: as many as there were checkpoints.
            marked = marked.withColumns(
                {
                    "query_id": F.when(open_batch, F.col("query_id")).otherwise("rewritten"),
                    "batch_id": F.when(open_batch, F.col("batch_id")).otherwise(0),
                }
            )
            dealt = marked.select(*SILVER_SCHEMA.names, *BATCH_COLUMNS, YEAR).repartition(target.buckets, *SALE_KEY)
            dealt.write.insertInto(target.name, overwrite=True)

    def _replace_batch(self, rows: DataFrame, query_id: str, batch_id: int) -> int:
        inserted = Observation("inserted")
        counted(rows, inserted).select(
            *SILVER_SCHEMA.names,
            F.lit(query_id).alias("query_id"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.year("date_of_sale").alias(YEAR),
        ).write.insertInto(self.name, overwrite=True)
        return inserted.get["rows"]


def counted(rows: DataFrame, seen: Observation) -> DataFrame:
    """The rows, counted by whatever reads them."""
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"))


def start_silver(
    bronze: DataFrame,
    table: SilverTable,
    checkpoint: str,
    mode: str = "once",
    period: str = PERIOD,
    counts: list[BatchCounts] | None = None,
) -> StreamingQuery:
    """Upsert new Bronze rows batch by batch; the table is the only state, so no row is ever too late.

    The counts of every batch are added to ``counts``.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        found = table.upsert(batch, query_id, batch_id)
        if counts is not None:
            counts.append(found)

    return (
        silver_rows(bronze)
        .writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_for(mode, period))
        .start()
    )
