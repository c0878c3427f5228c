"""Insert-only upsert: which rows of a batch are not in the target yet."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same_key(left: DataFrame, right: DataFrame, key: Sequence[str], null_safe: bool) -> Column:
    pairs = ((left[name], right[name]) for name in key)
    return reduce(Column.__and__, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))


def unseen_rows(fresh: DataFrame, target: DataFrame, key: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``fresh`` whose key ``target`` lacks. Keys of ``fresh`` are distinct.

    A key with a NULL part matches nothing under ``=`` and is always inserted; ``null_safe=True`` lets
    NULLs match. The semi join comes first because it lets the small side be the broadcast one: for a
    batch that AQE measures below the broadcast limit the target is only scanned, neither shuffled nor
    sorted. The anti join then meets no more rows than the batch has.
    """
    wanted = fresh.select(*key)
    held = target.select(*key)
    seen = held.join(wanted, _same_key(held, wanted, key, null_safe), "left_semi").alias("seen")
    return fresh.join(seen, _same_key(fresh, seen, key, null_safe), "left_anti")


def rows_of_keys(rows: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key, NULL parts included, is one of ``keys``."""
    keys = keys.select(*(F.col(name).alias(f"of_{name}") for name in key))
    same = reduce(Column.__and__, (F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in key))
    return rows.join(keys, same, "left_semi")
