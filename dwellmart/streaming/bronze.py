"""Bronze: every message as it came, all text, with its position in the topic."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dwellmart.schemas import BRONZE_SCHEMA, HEADERS, RAW_SCHEMA
from dwellmart.streaming.counters import OBSERVED
from dwellmart.streaming.triggers import PERIOD, trigger_for


def rename_headers(raw: DataFrame) -> DataFrame:
    """Header names of the register -> plain column names."""
    return raw.withColumnsRenamed(HEADERS)


def bronze_rows(envelopes: DataFrame) -> DataFrame:
    """Envelopes -> raw columns and lineage. A message that is no JSON gives a row of NULLs, not an error."""
    sale = F.from_json(F.col("value").cast("string"), RAW_SCHEMA)
    opened = envelopes.select(
        sale.alias("sale"),
        F.col("key").cast("string").alias("_kafka_key"),
        *(F.col(name).alias(f"_kafka_{name}") for name in ("topic", "partition", "offset", "timestamp")),
        F.current_timestamp().alias("_ingested_at"),
    )
    return rename_headers(opened.select("sale.*", *(c for c in opened.columns if c != "sale"))).select(
        *BRONZE_SCHEMA.names
    )


def start_bronze(
    envelopes: DataFrame, path: str, checkpoint: str, mode: str = "once", period: str = PERIOD
) -> StreamingQuery:
    """Append new messages to the table, counting them. A restart on the same checkpoint reads only what is new."""
    return (
        bronze_rows(envelopes)
        .observe(OBSERVED, F.count(F.lit(1)).alias("rows"))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_for(mode, period))
        .start(path)
    )
