"""Filters of the served table: chosen counties and types, latest year, lists to choose from."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Counties chosen at first where they exist, and how many to take where none does.
PREFERRED_COUNTIES = ["Dublin", "Cork", "Galway"]
FALLBACK_COUNT = 3


def choose(mart: DataFrame, counties: Sequence[str] | None = None, property_types: Sequence[str] | None = None) -> DataFrame:
    """Rows of the given counties and property types; ``None`` means every value but NULL."""
    chosen = mart
    for column, values in (("county", counties), ("property_type", property_types)):
        wanted = F.col(column).isNotNull() if values is None else F.col(column).isin(*values)
        chosen = chosen.where(wanted)
    return chosen


#: What a choice without rows is answered with.
NOTHING_CHOSEN = "no data for the chosen filters"


def nothing_chosen(chosen: DataFrame) -> bool:
    """Whether a choice leaves no rows. Reads one row at most."""
    return chosen.isEmpty()


def some_chosen(chosen: DataFrame) -> DataFrame:
    """The rows of a choice; the query fails with ``NOTHING_CHOSEN`` when it is run and finds none.

    The rows are counted in the run that returns them: a part of the plan adds no row and fails where the
    count is 0.
    """
    found = chosen.agg(F.count(F.lit(1)).alias("n"))
    failing = found.where(F.assert_true(F.col("n") > 0, NOTHING_CHOSEN).isNotNull())
    nothing = failing.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in chosen.schema))
    return chosen.unionByName(nothing)


def at_latest_year(rows: DataFrame) -> DataFrame:
    """Rows of the highest year among ``rows``. The year is a scalar subquery that the scan filters by."""
    return rows.where(F.col("year") == rows.agg(F.max("year")).scalar())


def choices(mart: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a column, without NULL."""
    return mart.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def default_counties(mart: DataFrame, preferred: Sequence[str] = PREFERRED_COUNTIES) -> DataFrame:
    """``position, county`` of the preferred counties that exist; if none does, of the first three by name.

    One top-k of the distinct counties brings the candidates together, so the window that tells the two
    cases apart sees only those few rows.
    """
    rank = F.array_position(F.array(*map(F.lit, preferred)), F.col("county"))
    rank = F.when(rank > 0, rank)
    candidates = (
        mart.select("county")
        .where(F.col("county").isNotNull())
        .distinct()
        .orderBy(rank.asc_nulls_last(), "county")
        .limit(max(len(preferred), FALLBACK_COUNT))
    )
    together = Window.partitionBy(F.lit(0)).orderBy(rank.asc_nulls_last(), "county")
    return (
        candidates.select(
            F.row_number().over(together).cast("int").alias("position"),
            "county",
            rank.isNotNull().alias("is_preferred"),
            F.min(rank).over(Window.partitionBy(F.lit(0))).isNotNull().alias("any_preferred"),
        )
        .where(F.col("is_preferred") | (~F.col("any_preferred") & (F.col("position") <= FALLBACK_COUNT)))
        .select("position", "county")
    )
