"""Exact duplicates, found with a persistent index of digests.

The index is a table with one row per different text: its SHA-256 digest and the row that stays. It is
bucketed and sorted by the digest, so that new data is looked up by a sort-merge anti-join in which only the
new data moves. What the join leaves is appended. Texts never move: a scan turns each into a digest and a
length, and all that follows works on those.

Files lie under ``batch=...``. A batch that is added again replaces its own files and looks itself up only
in the other batches, so that a job that is run again after a crash gives the same index and the same
verdicts.

A text that a large part of all rows share is one row per task after the first aggregation. Its rows meet
their verdict in a broadcast of the few largest groups, all others in a join of which no key is large.
"""

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmart.llm.stored import stored
from dwellmart.session import session_conf, shared_folder

#: Characters that texts may differ by and still count as equal.
WHITE = r"[\x20\x09-\x0D]+"
#: A group is large if it holds more than one in so many rows; there are fewer than that of them.
LARGE_SHARE = 4096
_LAYOUT = "buckets int"


def digest_of(text: Column) -> Column:
    """SHA-256 of the text without white space, as 32 bytes. NULL counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, ""), 256))


def _present(read: Callable[[], DataFrame]) -> bool:
    """Whether there is anything at the path that is read."""
    try:
        read()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


class DigestIndex:
    """The index at ``path``, in the shared folder of the cluster.

    ``buckets`` is fixed when the index is made and read back by whoever opens it again. Choose it so that
    a bucket's share of the digests of the largest batch is a few hundred MB (32 bytes a text). One writer
    at a time is assumed.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.data, self.layout = f"{path.rstrip('/')}/data", f"{path.rstrip('/')}/layout"
        self.name = f"digests_{hashlib.sha256(self.data.encode()).hexdigest()[:16]}"
        if _present(lambda: spark.read.schema(_LAYOUT).json(self.layout)):
            self.buckets = spark.read.schema(_LAYOUT).json(self.layout).first().buckets
        elif buckets is None:
            raise ValueError("a new index needs a number of buckets")
        else:
            self.buckets = buckets
            spark.createDataFrame([(buckets,)], _LAYOUT).coalesce(1).write.json(self.layout)

    def entries(self) -> DataFrame:
        """(digest, doc_id, row, length, copies, batch): the row that stays of each text.

        Its layout is known to the catalog of the session; other sessions may have added batches.
        """
        if not self.spark.catalog.tableExists(self.name):
            self.spark.sql(
                f"CREATE TABLE {self.name} "
                "(digest binary, doc_id bigint, `row` bigint, length int, copies bigint, batch string) USING parquet "
                "PARTITIONED BY (batch) "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.data}'"
            )
        if _present(lambda: self.spark.read.schema("digest binary").parquet(self.data)):
            self.spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def new_entries(self, groups: DataFrame, batch: str) -> DataFrame:
        """Groups whose text no other batch holds: a sort-merge anti-join that reads the index in place."""
        known = self.entries().where(F.col("batch") != batch).select("digest")
        return groups.join(known.hint("merge"), "digest", "left_anti")

    def add(self, docs: DataFrame, batch: str) -> DataFrame:
        """Add a batch of documents (doc_id, text) and tell for each row whether it stays.

        Returns one row per row: doc_id, keep_id, group_size, kept, text_sha256. Texts are equal if they are
        after white space is deleted. Of the equal rows of a batch the longest original text stays, then the
        smallest doc_id (NULL after all others), then one of the rows that are the same in both. Where an
        earlier batch holds the text, all rows go and keep_id is the document it kept. ``group_size`` counts
        the equal rows of this batch. NULL and empty texts are equal to each other and to texts of white
        space. An empty table gives no rows and adds nothing. Extra columns are not read.
        """
        text = F.coalesce(F.col("text"), F.lit(""))
        rows = stored(
            docs.select(
                F.monotonically_increasing_id().alias("row"),
                F.col("doc_id").cast("long").alias("doc_id"),
                F.char_length(text).alias("length"),
                digest_of(text).alias("digest"),
            ),
            "digests",
        )
        settings = {
            # Shuffles of the batch follow the buckets of the index, so that the index stays in place.
            "spark.sql.shuffle.partitions": str(self.buckets),
            "spark.sql.sources.partitionOverwriteMode": "dynamic",
        }
        with session_conf(self.spark, settings):
            first = F.struct((-F.col("length")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
            groups = rows.groupBy("digest").agg(F.min(first).alias("best"), F.count(F.lit(1)).alias("copies"))
            fresh = self.new_entries(groups, batch).select(
                "digest", "best.doc_id", "best.row", (-F.col("best.shorter")).alias("length"), "copies", F.lit(batch).alias("batch")
            )
            fresh.write.insertInto(self.name, overwrite=True)
            held = self.entries().select(
                "digest", F.col("doc_id").alias("keep_id"), F.when(F.col("batch") == batch, F.col("row")).alias("keep_row")
            )
            verdicts = stored(groups.select("digest", "copies").join(held.hint("merge"), "digest"), "verdicts")
        return _to_rows(rows, verdicts)


def _to_rows(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Each row with the verdict of its digest."""
    large = verdicts.where(F.col("copies") * LARGE_SHARE > rows.count())
    # Fewer than LARGE_SHARE groups can be that large, whatever the table.
    in_large = rows.join(F.broadcast(large), "digest")
    others = rows.join(F.broadcast(large.select("digest")), "digest", "left_anti")
    in_small = others.join(verdicts.where(F.col("copies") * LARGE_SHARE <= rows.count()), "digest")
    return in_large.unionByName(in_small).select(
        "doc_id",
        "keep_id",
        F.col("copies").alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, index: str | None = None, batch: str = "first", buckets: int | None = None) -> DataFrame:
    """Verdicts on the documents of a batch against the index at ``index``, or against a new one.

    A new index gets as many buckets as the session has shuffle partitions unless told otherwise.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DigestIndex(spark, index or shared_folder(spark, "digest-index"), buckets).add(docs, batch)
