"""Checks on a finished table and casts for its users."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the mart that must be filled, and types its users ask for.
REQUIRED_COLUMNS = ["county", "year", "transaction_count", "median_price_eur"]
EXPORT_TYPES = {
    "avg_price_eur": "double",
    "median_price_eur": "double",
    "min_price_eur": "double",
    "max_price_eur": "double",
    "year": "bigint",
    "transaction_count": "bigint",
}


class QualityError(ValueError):
    """A required column holds NULLs."""


def null_counts(table: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """``column_name, failures``: NULLs per column, all columns in one aggregation."""
    counts = table.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    return counts.unpivot([], list(columns), "column_name", "failures")


def require_filled(table: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> None:
    """Raise ``QualityError`` naming every column that holds NULLs."""
    failed = {row.column_name: row.failures for row in null_counts(table, columns).collect() if row.failures}
    if failed:
        raise QualityError(f"NULLs in required columns: {failed}")


def export_types(table: DataFrame) -> DataFrame:
    """Prices as double, whole numbers as bigint. A NULL whole number fails the query."""
    filled = lambda name: F.coalesce(F.col(name), F.raise_error(F.lit(f"{name} is NULL")).cast("bigint"))
    casts = {
        name: (filled(name) if kind == "bigint" else F.col(name)).cast(kind) for name, kind in EXPORT_TYPES.items()
    }
    return table.withColumns(casts)
