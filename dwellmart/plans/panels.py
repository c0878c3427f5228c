"""Datasets behind the panels of a price dashboard. All take the served frame and stay lazy.

A panel of a choice without rows fails with ``NOTHING_CHOSEN`` when it is run.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmart.functions.labels import change_label, euro_label
from dwellmart.operators.checks import export_types
from dwellmart.operators.county_map import weighted_median_by_county, with_coordinates
from dwellmart.operators.selection import at_latest_year, choose, some_chosen
from dwellmart.sources.counties import county_coordinates

SERVED_ORDER = ["county", "property_type", "year"]

Values = Sequence[str] | None


def price_summary(mart: DataFrame) -> DataFrame:
    """The served frame: the whole mart in the types and the order that its users get.

    Prices are doubles and whole numbers bigints; a NULL among the latter fails the query. The panels take
    this frame.
    """
    return export_types(mart).orderBy(*SERVED_ORDER)


def headline_metrics(served: DataFrame, counties: Sequence[str], property_types: Values = None) -> DataFrame | None:
    """Latest median and change per property type, for exactly one county; ``None`` for any other number."""
    if len(counties) != 1:
        return None
    return some_chosen(at_latest_year(choose(served, counties, property_types))).select(
        "county",
        "year",
        F.col("property_type").alias("label"),
        euro_label(F.col("median_price_eur")).alias("value"),
        change_label(F.col("median_price_change_pct")).alias("delta"),
    )


def trend_series(served: DataFrame, counties: Values = None, property_types: Values = None) -> DataFrame:
    """Points of one line per county and property type."""
    return some_chosen(choose(served, counties, property_types)).select("year", "median_price_eur", "county", "property_type")


def map_dataset(served: DataFrame, counties: Values = None, property_types: Values = None) -> DataFrame:
    """Weighted median per county in the latest year of the choice, with coordinates."""
    latest = some_chosen(at_latest_year(choose(served, counties, property_types)))
    return with_coordinates(weighted_median_by_county(latest), county_coordinates(served.sparkSession))


def underlying_table(served: DataFrame, counties: Values = None, property_types: Values = None) -> DataFrame:
    """The chosen rows in served order."""
    return some_chosen(choose(served, counties, property_types)).orderBy(*SERVED_ORDER)
