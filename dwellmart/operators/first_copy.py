"""Keep one row per key: the copy that arrived first."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_copy(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per distinct key, the one that comes first in ``order``; NULL keys equal each other.

    ``min_by`` aggregates before the shuffle, so a key that holds a large part of the rows sends at most
    one row per task. The survivor does not depend on task timing: a task that runs again after an
    executor is lost picks the same row.
    """
    rest = [name for name in rows.columns if name not in key]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first")
    return rows.groupBy(*key).agg(first).select(*key, "first.*").select(*rows.columns)
