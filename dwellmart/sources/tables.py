"""Reading and fully replacing stored tables.

A replaced table is a folder of loads. Each load is written to a folder of its own and counts from the moment its
writer has committed it; the catalog is then pointed at it. Who opened the table before keeps
reading the load before, which stays until the next one is complete. A load that fails changes nothing.
"""

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dwellmart.session import discard, paths_like


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or ``None`` if there is nothing at its path."""
    try:
        return read()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def loads(spark: SparkSession, path: str) -> list[str]:
    """Folders of the complete loads of a replaced table, oldest first."""
    done = paths_like(spark, f"{path.rstrip('/')}/load-*/_SUCCESS")
    return sorted(name.removesuffix("/_SUCCESS") for name in done)


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder that holds the rows of a table: its latest load, or the path itself if it is not replaced as a whole."""
    return [path, *loads(spark, path)][-1]


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Batch scan of a stored table. Filters and column choices of the caller reach the Parquet scan."""
    return spark.read.schema(schema).parquet(current_folder(spark, path))


def stream_table(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """An append-only table as a stream of its new rows."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def name_table(spark: SparkSession, name: str, path: str, schema: StructType) -> None:
    """Let the catalog know the latest load of a table by name."""
    folder = current_folder(spark, path)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, folder, "parquet", schema)


def replace_table(rows: DataFrame, path: str, name: str | None = None) -> int:
    """Replace the table by ``rows`` and return how many there were, counted while writing.

    With a ``name`` the catalog is pointed at the new load, in one step. ``rows`` may be read from the table itself.
    One load at a time is assumed.
    """
    spark, loaded = rows.sparkSession, Observation("replace_table")
    before = loads(spark, path)
    number = int(before[-1].rpartition("load-")[2].partition("-")[0]) + 1 if before else 0
    folder = f"{path.rstrip('/')}/load-{number:09d}-{uuid.uuid4().hex[:8]}"
    rows.observe(loaded, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    count = loaded.get["rows"]
    if name is not None:
        name_table(spark, name, path, rows.schema)
    kept = {stored.rpartition("/")[2] for stored in [*before[-1:], folder]}
    for stored in paths_like(spark, f"{path.rstrip('/')}/load-*"):
        if stored.rpartition("/")[2] not in kept:
            discard(spark, stored)
    return count
