"""Headline timings on the tables of ``BENCH_SF_DIR`` with ``BENCH_CPUS`` threads; prints one JSON line.

The raw sales are written as CSV first, untimed: they are the input a user has. Then every stage runs as
its job does, reading and writing stored tables, and the panels read the stored mart. All of it runs once
on another store to warm the JVM and once for the record.
"""

import json
import logging
import os
import time
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from dwellmart.operators import checks, selection
from dwellmart.plans import panels, pipeline
from dwellmart.plans.pipeline import Store
from dwellmart.session import build_session, shared_folder
from dwellmart.sources.sales_csv import scan_sales_csv, write_sales_csv
from dwellmart.sources.surrogate import raw_sales

# The published full run covers about 800,000 sales; so many different sales of each order come close to it.
TARGET_ROWS = 800_000


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def stages(spark: SparkSession, csv: str, store: Store) -> dict:
    raw = partial(scan_sales_csv, spark, csv)
    mart = partial(pipeline.read_mart, spark, store)
    served = lambda: panels.price_summary(mart())
    return {
        "csv_scan": lambda: run(raw()),
        "publish": lambda: pipeline.publish_job(raw(), store),
        "bronze": lambda: pipeline.bronze_job(spark, store),
        "silver_first_load": lambda: pipeline.silver_job(spark, store),
        "gold": lambda: pipeline.gold_job(spark, store),
        "warehouse": lambda: pipeline.warehouse_job(spark, store),
        "mart": lambda: pipeline.mart_job(spark, store),
        "check_not_null": lambda: run(checks.null_counts(mart())),
        "price_summary_sorted": lambda: run(served()),
        "default_selection": lambda: run(selection.default_counties(mart())),
        "headline_metrics": lambda: run(panels.headline_metrics(served(), ["Dublin"])),
        "trend_series": lambda: run(panels.trend_series(served(), ["Dublin", "Cork"])),
        "map_dataset": lambda: run(panels.map_dataset(served())),
        "underlying_table": lambda: run(panels.underlying_table(served(), ["Dublin", "Cork"])),
    }


def redelivery(spark: SparkSession, csv: str, store: Store) -> dict:
    """The same file sent once more: every sale is looked up in Silver and almost none is new."""
    later = stages(spark, csv, store)
    return {"publish_again": later["publish"], "bronze_again": later["bronze"], "silver_upsert": later["silver_first_load"]}


def main() -> None:
    logging.disable(logging.WARNING)
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("OFF")

    variants = max(1, round(TARGET_ROWS / raw_sales(spark, sf_dir, deliveries=1).count()))
    csv = shared_folder(spark, "csv")
    # One order file is one task; the register comes in as many pieces as there are threads.
    sales = raw_sales(spark, sf_dir, deliveries=1, spoiled=False, variants=variants)
    write_sales_csv(sales.repartition(int(cpus)), csv)
    rows = scan_sales_csv(spark, csv).count()

    seconds = {}
    for _ in ("warm", "record"):
        store = Store(shared_folder(spark, "store"), buckets=int(cpus))
        for name, job in {**stages(spark, csv, store), **redelivery(spark, csv, store)}.items():
            start = time.perf_counter()
            job()
            seconds[name] = round(time.perf_counter() - start, 3)

    whole = sum(seconds[s] for s in ("publish", "bronze", "silver_first_load", "gold", "warehouse", "mart", "check_not_null"))
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "sales": rows,
                "pipeline_sec": round(whole, 3),
                "pipeline_sales_per_sec": round(rows / whole),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
