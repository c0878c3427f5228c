"""The training-data pipeline: quality rules, toxicity, near duplicates, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept and calls one operator
of ``dwellmart.llm``. All but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession

from dwellmart.llm import mixing, packing, quality, simhash, toxicity
from dwellmart.llm.queries import importable, read
from dwellmart.session import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are called toxic go. The model learns from the labelled ones among ``docs``."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.one_of_each_group(docs, shingle_words=4, max_bits=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; documents are repeated or cut as the mix takes them."""
    return mixing.mixed_documents(docs)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows, as the packing operator returns them."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_documents),
    ("simhash_near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("packing", windows),
]

#: None: fitted models, fingerprint groups and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each written as Parquet and read back by the next."""
    importable(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
