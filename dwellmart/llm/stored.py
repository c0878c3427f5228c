"""Helpers of this subpackage: stored intermediate tables, fold numbers, runs of equal keys."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmart.session import discard, shared_folder

#: Words are runs of anything but these characters, in the operators that split at white space.
NOT_WHITE = r"[^\x20\x09-\x0D]+"


#: Folders stored in each block of ``temporary`` that is open, the innermost last.
_BLOCKS: list[list[str]] = []


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame, written once to the shared folder and read back: its lineage ends there."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    if _BLOCKS:
        _BLOCKS[-1].append(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Remove at the end of the block what ``stored`` has stored in it.

    Yields a function that stores what is needed after the block; it belongs to the block around, if any.
    Frames over other tables of the block are not to be run later.
    """
    _BLOCKS.append([])

    def keep(frame: DataFrame, purpose: str) -> DataFrame:
        inner = _BLOCKS.pop()
        try:
            return stored(frame, purpose)
        finally:
            _BLOCKS.append(inner)

    try:
        yield keep
    finally:
        for path in _BLOCKS.pop():
            discard(spark, path)


def with_row_key(docs: DataFrame, purpose: str) -> DataFrame:
    """The rows as a struct ``doc``, with a ``row`` key that is the same whenever the frame is read.

    Rows of files are known by their file and their place in it, so a frame that reads files, and does nothing
    else, is not stored. Any other frame is stored once and its rows are numbered.
    """
    if docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation":
        try:
            file = F.md5(F.col("_metadata.file_path").cast("binary"))
            return docs.select(
                F.struct(*docs.columns).alias("doc"),
                F.struct(file.alias("file"), F.col("_metadata.row_index").alias("place")).alias("row"),
            )
        except AnalysisException:
            # A format without places, or a column that hides them.
            pass
    place = F.struct(F.lit("").alias("file"), F.monotonically_increasing_id().alias("place"))
    return stored(docs.select(F.struct("*").alias("doc"), place.alias("row")), purpose)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``. A NULL id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, NULL as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def free_name(frame: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of the frame has that name."""
    taken = {name.lower() for name in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def table(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The rows of each run of equal keys, in a partition that is sorted by them.

    One run is held in memory at a time, so the caller bounds its length.
    """
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
        if held:
            rows = {name: np.concatenate([held[name], rows[name]]) for name in rows}
        changed = np.zeros(len(rows[keys[0]]) - 1, bool)
        for key in keys:
            changed |= rows[key][1:] != rows[key][:-1]
        start = 0
        for end in (np.flatnonzero(changed) + 1).tolist():
            yield {name: values[start:end] for name, values in rows.items()}
            start = end
        held = {name: values[start:] for name, values in rows.items()}
    if held:
        yield held


def smallest_linked(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For items 0..n-1 and links between them: the smallest item each can reach."""
    smallest = np.arange(n)
    while len(left):
        low = np.minimum(smallest[left], smallest[right])
        before = smallest.copy()
        np.minimum.at(smallest, left, low)
        np.minimum.at(smallest, right, low)
        smallest = smallest[smallest]
        if np.array_equal(before, smallest):
            break
    return smallest
