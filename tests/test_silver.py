import subprocess
import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from dwellmart.operators.first_copy import first_copy
from dwellmart.schemas import ARRIVAL_ORDER, BRONZE_SCHEMA, SALE_KEY, SILVER_SCHEMA
from dwellmart.session import session_conf
from dwellmart.sources.surrogate import raw_sales
from dwellmart.sources.tables import stream_table
from dwellmart.sources.topic import to_envelopes
from dwellmart.streaming.bronze import bronze_rows
from dwellmart.streaming.silver import SilverTable, silver_rows, start_silver

ROOT = Path(__file__).resolve().parent.parent
DAY = date(2020, 2, 1)


def sale(address, price="100.00", day=DAY, eircode="", offset=0):
    price = None if price is None else Decimal(price)
    return (day, address, "Cork", eircode, price, False, False, "House", "", "k", "t", 0, offset, datetime(2024, 1, 1), None)


def sales(spark, *rows):
    return spark.createDataFrame(list(rows), SILVER_SCHEMA)


def table(spark, folder, **kwargs):
    return SilverTable(spark, f"{folder}/silver", buckets=4, **kwargs)


def kept(spark, silver):
    return sorted((r.address or "", r.eircode) for r in silver.read(spark).collect())


def test_types_and_order_of_columns(spark, sf_dir):
    frame = silver_rows(bronze_rows(to_envelopes(raw_sales(spark, sf_dir), "t")))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in SILVER_SCHEMA]


def test_first_copy_is_the_one_that_arrived_first(spark):
    rows = sales(
        spark, sale("A", eircode="late", offset=9), sale("A", eircode="early", offset=2),
        sale(None, price=None, offset=4), sale(None, price=None, offset=3), sale("B"),
    )
    got = {(r.address, r.eircode, r._kafka_offset) for r in first_copy(rows, SALE_KEY, ARRIVAL_ORDER).collect()}
    assert got == {("A", "early", 2), (None, "", 3), ("B", "", 0)}


def test_matched_rows_stay_untouched(spark, folder):
    silver = table(spark, folder)
    silver.upsert(sales(spark, sale("A", eircode="old"), sale("A", eircode="twin", offset=1)), "q", 0)
    silver.upsert(sales(spark, sale("A", eircode="new"), sale("B", eircode="first")), "q", 1)
    assert kept(spark, silver) == [("A", "old"), ("B", "first")]


def test_same_batch_twice_changes_nothing_even_for_null_keys(spark, folder):
    silver = table(spark, folder)
    first = sales(spark, sale("A"), sale("N", price=None), sale("N", price=None))
    second = sales(spark, sale("B"), sale("N", price=None))
    counts = []
    for batch_id, batch in ((0, first), (0, first), (1, second), (1, second), (0, first)):
        silver.upsert(batch, "q", batch_id)
        counts.append(silver.read(spark).count())
    assert counts == [2, 2, 4, 4, 4]


def test_null_keys_match_nothing_unless_asked(spark, folder):
    batch = sales(spark, sale("N", price=None), sale("N", day=None), sale("A"))
    plain, safe = table(spark, f"{folder}/plain"), table(spark, f"{folder}/safe", null_safe=True)
    for batch_id in range(3):
        plain.upsert(batch, "q", batch_id)
        safe.upsert(batch, "q", batch_id)
    assert plain.read(spark).count() == 1 + 3 * 2
    assert safe.read(spark).count() == 3


def test_new_query_id_does_not_replace_older_batches(spark, folder):
    silver = table(spark, folder)
    silver.upsert(sales(spark, sale("A")), "first", 0)
    silver.upsert(sales(spark, sale("B")), "second", 0)
    assert kept(spark, silver) == [("A", ""), ("B", "")]


def test_a_new_catalog_finds_the_stored_batches(spark, folder):
    silver = table(spark, folder)
    silver.upsert(sales(spark, sale("A")), "q", 0)
    spark.sql(f"DROP TABLE {silver.name}")
    again = SilverTable(spark, f"{folder}/silver", buckets=16)
    assert again.buckets == 4
    again.upsert(sales(spark, sale("A"), sale("B")), "q2", 0)
    assert kept(spark, again) == [("A", ""), ("B", "")]


def test_session_settings_are_put_back(spark, folder):
    names = ["spark.sql.shuffle.partitions", "spark.sql.sources.partitionOverwriteMode"]
    before = [spark.conf.get(name, None) for name in names]
    table(spark, folder).upsert(sales(spark, sale("A")), "q", 0)
    assert [spark.conf.get(name, None) for name in names] == before


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_upsert_is_the_same_with_and_without_broadcast(spark, folder, limit):
    silver = table(spark, folder)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": limit}):
        silver.upsert(sales(spark, *(sale(f"{n} St") for n in range(0, 400))), "q", 0)
        silver.upsert(sales(spark, *(sale(f"{n} St", eircode="again") for n in range(200, 600))), "q", 1)
    stored = silver.read(spark)
    assert stored.count() == stored.select(*SALE_KEY).distinct().count() == 600
    assert stored.where(F.col("eircode") == "again").count() == 200


def test_one_key_holding_a_third_of_the_rows(spark, folder):
    hot = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id"))).alias("address"), "id"
    )
    rows = hot.select(
        *(
            F.col("address") if f.name == "address"
            else F.col("id").alias(f.name) if f.name == "_kafka_offset"
            else F.lit(DAY).alias(f.name) if f.name == "date_of_sale"
            else F.lit(Decimal("1.00")).cast(f.dataType).alias(f.name) if f.name == "price_eur"
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in SILVER_SCHEMA
        )
    )
    silver = table(spark, folder)
    silver.upsert(rows, "q", 0)
    silver.upsert(rows, "q", 1)
    assert silver.read(spark).count() == 40_001
    assert silver.read(spark).where("address = 'hot'").first()._kafka_offset == 0


def test_stream_replays_add_only_null_keys(spark, folder, sf_dir):
    bronze_rows(to_envelopes(raw_sales(spark, sf_dir), "t")).write.parquet(f"{folder}/bronze")
    silver = table(spark, folder)

    def ingest(checkpoint, **options):
        bronze = stream_table(spark, f"{folder}/bronze", BRONZE_SCHEMA, **options)
        start_silver(bronze, silver, f"{folder}/{checkpoint}").awaitTermination(300)
        return silver.read(spark)

    once = ingest("a")
    n, nulls = once.count(), once.where("date_of_sale IS NULL OR price_eur IS NULL").count()
    assert once.select(*SALE_KEY).distinct().count() == n
    assert ingest("a").count() == n
    assert ingest("b").count() == n + nulls
    assert nulls > 0


def test_small_micro_batches_give_the_same_keys(spark, folder, sf_dir):
    whole = bronze_rows(to_envelopes(raw_sales(spark, sf_dir), "t"))
    whole.repartition(3).write.parquet(f"{folder}/bronze")
    silver = table(spark, folder)
    bronze = stream_table(spark, f"{folder}/bronze", BRONZE_SCHEMA, maxFilesPerTrigger=1)
    start_silver(bronze, silver, f"{folder}/checkpoint").awaitTermination(300)
    expected = silver_rows(whole).select(*SALE_KEY).dropna().distinct()
    stored = silver.read(spark).select(*SALE_KEY).dropna()
    assert stored.count() == expected.count()
    assert stored.exceptAll(expected).isEmpty()


def upsert_in_another_process(folder, *addresses):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from dwellmart.session import build_session
from dwellmart.streaming.silver import SilverTable
from tests.test_silver import sale, sales
spark = build_session("other", "local[2]", spark__ui__enabled="false", spark__sql__warehouse__dir={folder!r} + "/other")
SilverTable(spark, {folder!r} + "/silver", buckets=4).upsert(sales(spark, *map(sale, {addresses!r})), "other", 0)
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)


def test_a_session_that_lives_on_sees_the_batches_of_others(spark, folder):
    silver = table(spark, folder)
    silver.upsert(sales(spark, sale("A")), "q", 0)
    upsert_in_another_process(folder, "B")
    silver.upsert(sales(spark, sale("B"), sale("A")), "q", 1)
    assert kept(spark, silver) == [("A", ""), ("B", "")]


def test_reading_alone_writes_nothing_and_a_new_table_needs_buckets(spark, folder):
    with pytest.raises(AnalysisException):
        SilverTable(spark, f"{folder}/silver").read(spark)
    with pytest.raises(AnalysisException):
        spark.read.text(f"{folder}/silver")
    with pytest.raises(ValueError, match="buckets"):
        SilverTable(spark, f"{folder}/silver").upsert(sales(spark, sale("A")), "q", 0)


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_look_up_reads_only_the_dates_of_the_batch_in_place(spark, folder, limit):
    silver = table(spark, folder)
    silver.upsert(sales(spark, *(sale(f"{n}", day=date(2020, 1, 1 + n % 28)) for n in range(200))), "q", 0)
    batch = sales(spark, sale("7", day=date(2020, 1, 8)), sale("new", day=date(2020, 1, 9)))
    batch.write.parquet(f"{folder}/fresh")
    settings = {"spark.sql.autoBroadcastJoinThreshold": limit, "spark.sql.shuffle.partitions": "4"}
    with session_conf(spark, settings):
        found = silver.unseen(spark.read.schema(SILVER_SCHEMA).parquet(f"{folder}/fresh"), spark.table(silver.name))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert [r.address for r in found.collect()] == ["new"]
    scan = plan[plan.index(f"{silver.name}[") :] if f"{silver.name}[" in plan else plan
    assert "GreaterThanOrEqual(date_of_sale,2020-01-08)" in plan and "LessThanOrEqual(date_of_sale,2020-01-09)" in plan
    assert "Bucketed: true" in plan or "Bucketed: false (disabled by query planner)" in scan


def test_look_up_passes_by_other_years(spark, folder):
    silver = table(spark, folder)
    days = [date(year, 3, 1 + n) for year in (2010, 2015, 2019, 2020) for n in range(5)]
    silver.upsert(sales(spark, *(sale(f"{day}", day=day) for day in days), sale("N", day=None)), "q", 0)
    batch = sales(spark, sale("2010-03-02", day=date(2010, 3, 2)), sale("2020-03-05", day=date(2020, 3, 5)), sale("N", day=None))
    batch.write.parquet(f"{folder}/fresh")
    fresh = spark.read.schema(SILVER_SCHEMA).parquet(f"{folder}/fresh")
    for null_safe, new in ((False, ["N"]), (True, [])):
        silver.null_safe = null_safe
        found = silver.unseen(fresh, spark.table(silver.name))
        plan = found._jdf.queryExecution().executedPlan().toString()
        filters = next(part for part in plan.split("PartitionFilters: ") if "sale_year#" in part.split("]")[0])
        filters = filters.split("PushedFilters")[0]
        assert "2010" in filters and "2020" in filters and "2015" not in filters
        # Files of the other two years are not even opened.
        years = {name.split("sale_year=")[1].split("/")[0] for name in spark.table(silver.name).where(
            F.col("sale_year").isin(2010, 2020)).inputFiles()}
        assert years == {"2010", "2020"}
        assert [r.address for r in found.collect()] == new


@pytest.mark.parametrize("few", [0, 100_000])
def test_rows_do_not_depend_on_how_many_keys_are_new(spark, folder, monkeypatch, few):
    monkeypatch.setattr("dwellmart.streaming.silver.FEW_KEYS", few)
    silver = table(spark, folder)
    silver.upsert(sales(spark, sale("A", eircode="old"), sale("N", price=None, eircode="null 0")), "q", 0)
    batch = sales(
        spark, sale("A", eircode="new", offset=1), sale("B", eircode="later", offset=9), sale("B", eircode="first", offset=3),
        sale("N", price=None, eircode="null 1", offset=8), sale("N", price=None, eircode="null 2", offset=7),
        sale("A", day=date(1999, 1, 1), eircode="other year"),
    )
    for _ in range(2):
        silver.upsert(batch, "q", 1)
        assert kept(spark, silver) == [("A", "old"), ("A", "other year"), ("B", "first"), ("N", "null 0"), ("N", "null 2")]


def test_rewrite_keeps_the_rows_and_the_batches_that_may_come_again(spark, folder):
    silver = table(spark, folder)
    for n in range(3):
        silver.upsert(sales(spark, sale(f"{n}"), sale("N", price=None)), "q", n)
    larger = SilverTable(spark, f"{folder}/rewritten", buckets=2)
    silver.rewrite(spark, larger)
    assert kept(spark, larger) == kept(spark, silver) and larger.buckets == 2
    larger.upsert(sales(spark, sale("2"), sale("N", price=None)), "q", 2)
    assert kept(spark, larger) == kept(spark, silver)
