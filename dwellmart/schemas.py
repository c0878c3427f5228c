"""Declared schemas of every stage. Nothing in the library infers a schema."""

from pyspark.sql import types as T

# Header of the sales register file -> column name used downstream.
HEADERS = {
    "Date of Sale (dd/mm/yyyy)": "date_of_sale",
    "Address": "address",
    "County": "county",
    "Eircode": "eircode",
    "Price (€)": "price_eur",
    "Not Full Market Price": "not_full_market_price",
    "VAT Exclusive": "vat_exclusive",
    "Description of Property": "description_of_property",
    "Property Size Description": "property_size_description",
}

# The source carries no sale id, so these three columns stand in for one.
SALE_KEY = ["address", "date_of_sale", "price_eur"]

# One summary row per county, year and kind of property.
SUMMARY_KEY = ["county", "year", "description_of_property"]

PRICE_TYPE = T.DecimalType(12, 2)


def _strings(names) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


RAW_SCHEMA = T.StructType(_strings(HEADERS))

ENVELOPE_SCHEMA = (
    T.StructType()
    .add("key", T.BinaryType())
    .add("value", T.BinaryType())
    .add("topic", T.StringType())
    .add("partition", T.IntegerType())
    .add("offset", T.LongType())
    .add("timestamp", T.TimestampType())
)

# Position of the message a row came from, and when it was ingested.
LINEAGE_FIELDS = [
    T.StructField("_kafka_key", T.StringType()),
    T.StructField("_kafka_topic", T.StringType()),
    T.StructField("_kafka_partition", T.IntegerType()),
    T.StructField("_kafka_offset", T.LongType()),
    T.StructField("_kafka_timestamp", T.TimestampType()),
    T.StructField("_ingested_at", T.TimestampType()),
]

# Oldest message first; decides which copy of a sale is kept.
ARRIVAL_ORDER = ["_kafka_timestamp", "_kafka_partition", "_kafka_offset"]

SALE_COLUMNS = list(HEADERS.values())

BRONZE_SCHEMA = T.StructType(_strings(SALE_COLUMNS) + LINEAGE_FIELDS)

_TYPED = {
    "date_of_sale": T.DateType(),
    "price_eur": PRICE_TYPE,
    "not_full_market_price": T.BooleanType(),
    "vat_exclusive": T.BooleanType(),
}

SILVER_SCHEMA = T.StructType(
    [T.StructField(f.name, _TYPED.get(f.name, f.dataType)) for f in BRONZE_SCHEMA]
)

GOLD_SCHEMA = (
    T.StructType()
    .add("county", T.StringType())
    .add("year", T.IntegerType())
    .add("description_of_property", T.StringType())
    .add("transaction_count", T.LongType())
    .add("avg_price_eur", T.DecimalType(16, 6))
    .add("median_price_eur", T.DoubleType())
    .add("min_price_eur", PRICE_TYPE)
    .add("max_price_eur", PRICE_TYPE)
)

MART_SCHEMA = T.StructType(
    [
        T.StructField("property_type" if f.name == "description_of_property" else f.name, f.dataType)
        for f in GOLD_SCHEMA
    ]
    + [
        T.StructField("median_price_change_eur", T.DoubleType()),
        T.StructField("median_price_change_pct", T.DoubleType()),
    ]
)
