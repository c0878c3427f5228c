import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dwellmart.operators.price_summary import summarise_prices
from dwellmart.schemas import GOLD_SCHEMA, SUMMARY_KEY
from dwellmart.session import session_conf
from tests.comparison import spark_bag

COLUMNS = "county string, date_of_sale date, description_of_property string, price_eur decimal(12,2)"
DAY = date(2020, 2, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def built_in(sales):
    """The same figures with Spark's own median, which keeps a group in one task."""
    return sales.groupBy("county", F.year("date_of_sale").alias("year"), "description_of_property").agg(
        F.count("*").alias("transaction_count"),
        F.avg("price_eur").alias("avg_price_eur"),
        F.median("price_eur").alias("median_price_eur"),
        F.min("price_eur").alias("min_price_eur"),
        F.max("price_eur").alias("max_price_eur"),
    )


def prices(spark, *texts):
    return frame(spark, [("Cork", DAY, "House", None if t is None else Decimal(t)) for t in texts])


@pytest.mark.parametrize(
    "texts, median",
    [
        (["5.00"], 5.0),
        (["1.00", "2.00"], 1.5),
        (["3.00", "1.00", "2.00"], 2.0),
        (["1.00", "1.00", "9.00", "9.00"], 5.0),
        (["1.00", "1.00", "1.00", "9.00"], 1.0),
        # Middle ranks in two bins, next to each other or far apart.
        (["9999.99", "10000.00"], 9999.995),
        (["1.00", "2.00", "9999999999.98", "9999999999.99"], 5000000000.99),
        (["0.00", "0.00", None], 0.0),
        ([None, None], None),
    ],
)
def test_median(spark, texts, median):
    sales = prices(spark, *texts)
    row = summarise_prices(sales).first()
    # To the last bit what Spark's own median gives; the literal is what a reader expects.
    assert row.median_price_eur == built_in(sales).first().median_price_eur
    assert row.median_price_eur == (None if median is None else pytest.approx(median, rel=1e-15))
    assert row.transaction_count == len(texts)


def test_types(spark):
    got = summarise_prices(prices(spark, "1.00")).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in GOLD_SCHEMA]


def test_null_keys_form_groups_and_null_prices_count(spark):
    rows = [(None, None, None, Decimal("4.00")), (None, None, None, None), (None, DAY, "House", None), ("Cork", DAY, None, Decimal(1))]
    got = summarise_prices(frame(spark, rows))
    assert spark_bag(got) == spark_bag(built_in(frame(spark, rows)))
    assert got.where("county IS NULL AND year IS NULL").first().transaction_count == 2


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_random_groups_match_the_built_in_aggregates(spark, seed, limit):
    draw = random.Random(seed)
    spread = draw.choice([50, 20_000, 500_000, 10_000_000_000])
    rows = [
        (
            draw.choice(["Cork", "Mayo", None]),
            draw.choice([DAY, date(2021, 5, 5), None]),
            draw.choice(["House", "Flat"]),
            draw.choice([None, Decimal(draw.randrange(spread * 100)) / 100, Decimal(draw.randrange(spread)), Decimal(7)]),
        )
        for _ in range(draw.randrange(1, 1500))
    ]
    sales = frame(spark, rows)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": limit}):
        assert spark_bag(summarise_prices(sales)) == spark_bag(built_in(sales))


def test_one_group_holding_most_rows(spark):
    sales = spark.range(300_000).select(
        F.when(F.col("id") % 10 < 9, "Dublin").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("county"),
        F.lit(DAY).alias("date_of_sale"),
        F.lit("House").alias("description_of_property"),
        (F.pmod(F.xxhash64("id"), F.lit(200_000_000)) / 100).cast("decimal(12,2)").alias("price_eur"),
    )
    assert spark_bag(summarise_prices(sales)) == spark_bag(built_in(sales))


def test_sales_are_combined_before_every_shuffle(spark, folder):
    prices(spark, "1.00", "2.00").write.parquet(folder)
    plan = summarise_prices(spark.read.parquet(folder))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    # From the scan upwards: join with the middle bins, partial count, and only then the first shuffle.
    lines = [line.strip(" :+-*()0123456789") for line in plan.splitlines()]
    shuffle = max(i for i, line in enumerate(lines) if line.startswith("Exchange"))
    assert lines[shuffle + 1].startswith("HashAggregate") and "partial_count" in lines[shuffle + 1]


def test_only_four_columns_are_read(spark, folder):
    prices(spark, "1.00").withColumn("address", F.lit("x")).write.parquet(folder)
    plan = summarise_prices(spark.read.parquet(folder))._jdf.queryExecution().executedPlan().toString()
    assert "address" not in plan


def test_counts_add_up_to_the_sales(spark, sf_dir):
    from dwellmart.plans.registered import silver_of

    silver = silver_of(spark, sf_dir)
    gold = summarise_prices(silver)
    assert gold.agg(F.sum("transaction_count")).first()[0] == silver.count()
    assert gold.count() == gold.select(*SUMMARY_KEY).distinct().count()
