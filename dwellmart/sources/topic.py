"""The message topic: keyed JSON envelopes, written and read in batch or as a stream.

The topic is a folder of Parquet files with the envelope columns of the Kafka source. Where the Kafka
package is installed the same functions take ``format="kafka"`` with its options.

Topic, partition and offset name one message for good. Every task numbers its own rows, a publish begins
above the highest offset there is, and that one is noted beside the messages when a publish has ended. If one
has not, its files are newer than the note, and the next publish looks into just these. One publish at a
time is assumed.
"""

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dwellmart.schemas import ENVELOPE_SCHEMA, HEADERS
from dwellmart.sources.tables import if_present

_BY_NAME = {name: header for header, name in HEADERS.items()}

#: Most tasks of a publish. Offsets of one task are so far apart, and those of different tasks lie between.
MOST_TASKS = 1 << 20
#: Where the highest offset is noted; readers of the topic pass by names that begin like this.
_MARKS = "_marks"
#: A store may keep whole seconds of the time of a file only.
CLOCK = timedelta(seconds=2)


@dataclass(frozen=True)
class Published:
    """Outcome of a publish. A row that cannot be written fails the job, so ``failed`` is always 0."""

    sent: int
    failed: int = 0
    last_offset: int | None = None


def _raw(name: str) -> Column:
    return F.col(f"`{_BY_NAME[name]}`")


def message_key() -> Column:
    """``address-date``. A missing address counts as empty, a missing date as an id of the row."""
    row_id = (F.monotonically_increasing_id() + 1).cast("string")
    key = F.concat(F.coalesce(_raw("address"), F.lit("")), F.lit("-"), F.coalesce(_raw("date_of_sale"), row_id))
    return F.nullif(key, F.lit(""))


def message_value() -> Column:
    """The raw row as a JSON object; NULL cells are written out as ``null``."""
    return F.to_json(F.struct(*(F.col(f"`{header}`") for header in HEADERS)), {"ignoreNullFields": "false"})


def message_offset(first: int) -> Column:
    """Offsets from ``first`` on: unique in a publish, and rising along each task and so along each partition in it."""
    number = F.monotonically_increasing_id()  # the task in the upper bits, its row in the lower 33
    task, row = F.shiftright(number, 33), number.bitwiseAND((1 << 33) - 1)
    too_many = F.raise_error(F.lit(f"a publish has at most {MOST_TASKS} tasks")).cast("long")
    return F.when(task < MOST_TASKS, F.lit(first) + row * MOST_TASKS + task).otherwise(too_many)


def to_envelopes(raw: DataFrame, topic: str, partitions: int = 8, first_offset: int = 0) -> DataFrame:
    """One envelope per raw row. The whole job is a projection: no shuffle. Offsets are not dense."""
    keyed = raw.select(message_key().alias("key"), message_value().alias("value"))
    return keyed.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash("key"), F.lit(partitions)).alias("partition"),
        message_offset(first_offset).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def next_offset(spark: SparkSession, source: str) -> int:
    """An offset above all that the topic holds: from the note of the last publish and from newer files."""
    notes = if_present(lambda: spark.read.schema("last_offset long").json(f"{source}/{_MARKS}"))
    reader, noted = spark.read.schema(ENVELOPE_SCHEMA), -1
    if notes is not None:
        noted, at = notes.agg(F.max("last_offset"), F.max("_metadata.file_modification_time")).first()
        zone = spark.conf.get("spark.sql.session.timeZone")
        since = notes.select(F.date_format(F.lit(at - CLOCK), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
        reader = reader.option("modifiedAfter", since).option("timeZone", zone)
    messages = if_present(lambda: reader.parquet(source))
    newer = None if messages is None else messages.agg(F.max("offset")).first()[0]
    return max(noted, -1 if newer is None else newer) + 1


def publish(raw: DataFrame, target: str, topic: str, partitions: int = 8, format: str = "parquet", **options) -> Published:
    """Append every raw row to the topic and count them on the way, in the one pass that writes."""
    spark, seen = raw.sparkSession, Observation("publish")
    first = 0 if format == "kafka" else next_offset(spark, target)
    envelopes = to_envelopes(raw, topic, partitions, first)
    envelopes = envelopes.observe(seen, F.count(F.lit(1)).alias("sent"), F.max("offset").alias("last"))
    if format == "kafka":
        # The brokers give the messages their offsets.
        envelopes.select("key", "value", "topic").write.format("kafka").options(**options).save()
        return Published(sent=seen.get["sent"])
    envelopes.write.format(format).mode("append").options(**options).save(target)
    last = seen.get["last"]
    if last is not None:
        note = spark.createDataFrame([(last,)], "last_offset long").coalesce(1)
        note.write.mode("append").json(f"{target}/{_MARKS}")
    return Published(sent=seen.get["sent"], last_offset=last)


def read_topic(spark: SparkSession, source: str) -> DataFrame:
    """The whole topic as a batch."""
    return spark.read.schema(ENVELOPE_SCHEMA).parquet(source)


def stream_topic(
    spark: SparkSession, source: str, format: str = "parquet", start: str | None = None, **options
) -> DataFrame:
    """The topic as a stream, from its first message on unless told otherwise.

    With ``start``, a timestamp, a fresh checkpoint begins at the first message of that time or later, and
    files of earlier messages are passed by through their statistics. It holds for the whole life of
    the checkpoint, which loses nothing: messages are stamped in the order of their publishes.

    For ``format="kafka"`` the source is the topic name and the options name the brokers.
    """
    if format == "kafka":
        begin = {"startingOffsets": "earliest"}
        if start is not None:
            at = spark.sql("SELECT unix_millis(CAST(? AS timestamp))", [start]).first()[0]
            begin = {"startingTimestamp": str(at), "startingOffsetsByTimestampStrategy": "latest"}
        return spark.readStream.format("kafka").options(**{**begin, "subscribe": source, **options}).load()
    messages = spark.readStream.format(format).schema(ENVELOPE_SCHEMA).options(**options).load(source)
    return messages if start is None else messages.where(F.col("timestamp") >= F.lit(start).cast("timestamp"))
