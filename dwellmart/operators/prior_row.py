"""Change of the median price against the row before it in the same series."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellmart.schemas import MART_SCHEMA

SERIES = ["county", "property_type"]


def with_prior_median(staged: DataFrame) -> DataFrame:
    """Add the median of the previous row on record: after a gap that is not the year before.

    A series has one row per calendar year, which bounds every window.
    """
    series = Window.partitionBy(*SERIES).orderBy("year")
    return staged.withColumn("prior_median_eur", F.lag("median_price_eur").over(series))


def with_change(rows: DataFrame) -> DataFrame:
    """Absolute and percent change. The first row of a series has neither; a prior of 0 is an error."""
    now, prior = F.col("median_price_eur"), F.col("prior_median_eur")
    return rows.withColumns(
        {
            "median_price_change_eur": now - prior,
            "median_price_change_pct": F.round(100 * (now - prior) / prior, 2),
        }
    ).select(*MART_SCHEMA.names)
