"""One figure per county and its place on the map."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weighted_median_by_county(rows: DataFrame) -> DataFrame:
    """Mean of the medians weighted by sales, with both sums. Rows without a county are left out."""
    sums = (
        rows.where(F.col("county").isNotNull())
        .groupBy("county")
        .agg(
            F.sum(F.col("median_price_eur") * F.col("transaction_count")).alias("_weighted_price_sum"),
            F.sum("transaction_count").alias("total_transactions"),
        )
    )
    return sums.withColumn(
        "weighted_median_price_eur", F.col("_weighted_price_sum") / F.col("total_transactions")
    )


def with_coordinates(rows: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Add ``lat`` and ``lon`` by county and drop counties without a place.

    The size of ``coordinates`` decides the join: the fixed county table comes marked for broadcast, for
    any other table AQE looks at its size.
    """
    return rows.join(coordinates, "county", "left").dropna(subset=["lat", "lon"])
