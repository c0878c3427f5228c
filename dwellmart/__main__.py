"""Run one stage, or all of them: ``spark-submit --py-files … dwellmart/__main__.py all --csv … --root …``.

A stage that fails raises, so the process ends with a status other than 0.
"""

import argparse
import logging

from dwellmart.plans.pipeline import (
    Store,
    bronze_job,
    check_job,
    gold_job,
    mart_job,
    publish_job,
    run_pipeline,
    silver_job,
    warehouse_job,
)
from dwellmart.session import build_session
from dwellmart.sources.sales_csv import PARSERS, PLAIN, scan_sales_csv
from dwellmart.streaming.triggers import PERIOD

STAGES = ["publish", "bronze", "silver", "gold", "warehouse", "mart", "check", "all"]


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="dwellmart", description=__doc__)
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("--root", required=True, help="shared folder of all tables and stream positions")
    parser.add_argument("--csv", help="register file or folder; needed by publish and all")
    parser.add_argument("--topic", default="property_sales")
    parser.add_argument("--buckets", type=int, help="buckets of a new Silver table; needed by its first batch")
    parser.add_argument("--max-files", type=int, default=1000, help="most files per Silver micro-batch")
    parser.add_argument(
        "--csv-parser", choices=(*PARSERS, PLAIN), default="auto",
        help="records: no look at the files first; plain: none, and files with line breaks in cells fail",
    )
    parser.add_argument("--kafka", metavar="SERVERS", help="use a Kafka topic at these brokers")
    parser.add_argument("--starting-offsets", default="earliest", help="where a new Bronze stream starts in Kafka")
    parser.add_argument("--starting-time", help="time of the first message that a new Bronze stream takes in")
    parser.add_argument(
        "--trigger", default="once", help="once; until_idle: periodic until nothing is new; anything else: periodic"
    )
    parser.add_argument("--period", default=PERIOD)
    parser.add_argument("--master")
    options = parser.parse_args(argv)
    if options.stage in ("publish", "all") and not options.csv:
        parser.error(f"{options.stage} needs --csv")
    return options


def store_of(options: argparse.Namespace) -> Store:
    kafka = {"kafka.bootstrap.servers": options.kafka, "startingOffsets": options.starting_offsets}
    return Store(
        options.root,
        options.topic,
        options.buckets,
        {"maxFilesPerTrigger": options.max_files},
        "kafka" if options.kafka else "parquet",
        kafka if options.kafka else {},
        options.starting_time,
    )


def main(argv: list[str] | None = None) -> None:
    options = arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = build_session(f"dwellmart-{options.stage}", options.master)
    store = store_of(options)
    jobs = {
        "publish": lambda: publish_job(scan_sales_csv(spark, options.csv, options.csv_parser), store),
        "bronze": lambda: bronze_job(spark, store, options.trigger, options.period),
        "silver": lambda: silver_job(spark, store),
        "gold": lambda: gold_job(spark, store),
        "warehouse": lambda: warehouse_job(spark, store),
        "mart": lambda: mart_job(spark, store),
        "check": lambda: check_job(spark, store),
        "all": lambda: run_pipeline(spark, options.csv, store, parser=options.csv_parser),
    }
    jobs[options.stage]()


if __name__ == "__main__":
    main()
