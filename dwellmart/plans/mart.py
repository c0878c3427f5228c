"""From the stored summary to the served mart."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmart.operators.prior_row import with_change, with_prior_median

# A temporary view of its own name, so that it never hides the stored table of that name.
SOURCE = "given_price_summary"
STAGING = "staged_price_summary"


def register_source(gold: DataFrame, name: str = SOURCE) -> None:
    """Give the summary a name the staging view can refer to."""
    gold.createOrReplaceTempView(name)


def staging_view(spark: SparkSession, source: str = SOURCE, view: str = STAGING) -> DataFrame:
    """A view over the named source in which the kind of property is called ``property_type``."""
    staged = spark.table(source).select(
        "county",
        "year",
        F.col("description_of_property").alias("property_type"),
        "transaction_count",
        "avg_price_eur",
        "median_price_eur",
        "min_price_eur",
        "max_price_eur",
    )
    staged.createOrReplaceTempView(view)
    return spark.table(view)


def mart_rows(staged: DataFrame) -> DataFrame:
    """Staged summary with the change of the median against the previous row of its series."""
    return with_change(with_prior_median(staged))


def build_mart(spark: SparkSession, gold: DataFrame) -> DataFrame:
    """Summary -> named source -> staging view -> mart, as one lazy plan over the summary.

    Making that summary is not lazy: ``summarise_prices`` stores its first pass when it is called.
    """
    register_source(gold)
    return mart_rows(staging_view(spark))
