"""Price summary per county, year and kind of property, with an exact median at any group size.

Spark's ``median`` keeps every distinct price of a group in one task. One group may hold a third of all
sales, so the median is found in two bounded passes over four columns of Silver instead:

1. Prices fall into bins of 10,000 euro. Count, sum, lowest and highest price per (group, bin) are
   combined before their shuffle, which therefore carries a few rows per group and task. The running
   count over the bins of a group shows which bin, or which two, hold its middle ranks.
2. Only sales whose price lies in such a bin are counted per price, again combined before the shuffle,
   and ranked.

A decimal(12,2) price allows at most 10^6 bins in a group and 10^6 prices in a bin. No window holds more
rows than that, however many sales the group has.

The result of the first pass, two rows per group at most, is written to the shared folder. Read back, it
has a known size, and Spark broadcasts it if that is below its limit: then no sale is shuffled as such in
either pass. Above the limit Spark joins by shuffle, where AQE splits skewed partitions.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellmart.schemas import GOLD_SCHEMA, SUMMARY_KEY
from dwellmart.session import shared_folder

BIN_EUR = 10_000
BIN_KEY = [*SUMMARY_KEY, "bin"]
_TOTALS = ["transaction_count", "total", "all_priced", "min_price_eur", "max_price_eur"]


def _binned(sales: DataFrame) -> DataFrame:
    # Truncation keeps the bins in price order; prices are never negative.
    return sales.select(
        "county",
        F.year("date_of_sale").alias("year"),
        "description_of_property",
        "price_eur",
        F.expr(f"cast(price_eur as bigint) div {BIN_EUR}").alias("bin"),
    )


def _middle_bins(binned: DataFrame) -> DataFrame:
    """The bins that hold the middle ranks of each group, with the totals of the group."""
    bins = binned.groupBy(*BIN_KEY).agg(
        F.count(F.lit(1)).alias("sales"),
        # Sales without a price sit in the NULL bin: they count as transactions and have no rank.
        F.count("price_eur").alias("priced"),
        F.sum("price_eur").alias("worth"),
        F.min("price_eur").alias("lowest"),
        F.max("price_eur").alias("highest"),
    )
    group = Window.partitionBy(*SUMMARY_KEY)
    upto = F.sum("priced").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    low, high, last = F.col("low_rank"), F.col("high_rank"), F.col("before") + F.col("priced")
    return (
        bins.select(
            *BIN_KEY,
            "priced",
            (upto - F.col("priced")).alias("before"),
            F.sum("priced").over(group).alias("all_priced"),
            F.sum("sales").over(group).alias("transaction_count"),
            F.sum("worth").over(group).alias("total"),
            F.min("lowest").over(group).alias("min_price_eur"),
            F.max("highest").over(group).alias("max_price_eur"),
        )
        .withColumn("low_rank", F.expr("(all_priced + 1) div 2"))
        .withColumn("high_rank", F.expr("all_priced div 2 + 1"))
        # A group without any price keeps its one NULL bin, and through it its row.
        .where(
            ((F.col("before") < low) & (low <= last))
            | ((F.col("before") < high) & (high <= last))
            | (F.col("all_priced") == 0)
        )
        .drop("priced")
    )


def summarise_prices(sales: DataFrame, workspace: str | None = None) -> DataFrame:
    """Silver rows -> count, mean, exact median, lowest and highest price per group (``GOLD_SCHEMA``).

    NULL key values form groups of their own. The count covers all rows, the other figures skip NULL
    prices. An even count takes the mean of the two middle prices.

    The first pass runs at once and writes to ``workspace``, by default a new shared folder; the second is
    lazy. ``sales`` must give the same rows both times, as a stored table does.
    """
    spark = sales.sparkSession
    binned = _binned(sales)
    workspace = workspace or shared_folder(spark, "middle-bins")
    first_pass = _middle_bins(binned)
    first_pass.write.mode("overwrite").parquet(workspace)
    middle = spark.read.schema(first_pass.schema).parquet(workspace).alias("middle")
    # NULL-safe, because NULL groups must meet too.
    same_bin = reduce(Column.__and__, (F.col(f"sale.{c}").eqNullSafe(F.col(f"middle.{c}")) for c in BIN_KEY))
    carried = [*_TOTALS, "before", "low_rank", "high_rank"]
    per_price = (
        binned.alias("sale")
        .join(middle, same_bin)
        .groupBy(*(F.col(f"sale.{c}") for c in SUMMARY_KEY), "price_eur")
        .agg(F.count(F.lit(1)).alias("sales"), *(F.max(c).alias(c) for c in carried))
    )
    # The middle bins of a group lie next to each other, so one running count goes through both.
    by_price = Window.partitionBy(*SUMMARY_KEY).orderBy("price_eur")
    so_far = by_price.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = per_price.withColumn(
        "last", F.min("before").over(so_far) + F.sum("sales").over(so_far)
    ).withColumn("first", F.col("last") - F.col("sales") + 1)
    at_middle = F.col("low_rank").between(F.col("first"), F.col("last")) | F.col("high_rank").between(
        F.col("first"), F.col("last")
    )
    grouped = (
        ranked.where(at_middle | (F.col("all_priced") == 0))
        .groupBy(*SUMMARY_KEY)
        .agg(
            *(F.max(name).alias(name) for name in _TOTALS),
            F.min("price_eur").cast("double").alias("low"),
            F.max("price_eur").cast("double").alias("high"),
        )
    )
    # At 38 digits the quotient has the six decimals of the result and is rounded only once.
    total = F.col("total").cast("decimal(38,2)")
    figures = {
        "avg_price_eur": total / F.nullif(F.col("all_priced"), F.lit(0)),
        "median_price_eur": 0.5 * F.col("low") + 0.5 * F.col("high"),
    }
    return grouped.select(
        *(figures.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in GOLD_SCHEMA)
    )
