import pytest

from dwellmart.__main__ import arguments, main, store_of
from dwellmart.operators.checks import QualityError
from dwellmart.plans.pipeline import Store, read_mart
from dwellmart.sources.sales_csv import write_sales_csv
from dwellmart.sources.surrogate import raw_sales


def test_stages_one_by_one(spark, folder, sf_dir):
    write_sales_csv(raw_sales(spark, sf_dir), f"{folder}/csv")
    root = f"{folder}/store"
    main(["publish", "--csv", f"{folder}/csv", "--root", root])
    for stage in ("bronze", "silver", "gold", "warehouse", "mart"):
        main([stage, "--root", root, "--buckets", "4"])
    assert not read_mart(spark, Store(root)).isEmpty()
    with pytest.raises(QualityError):
        main(["check", "--root", root])


def test_publish_needs_a_file():
    with pytest.raises(SystemExit):
        arguments(["publish", "--root", "x"])


def test_kafka_options_reach_the_store():
    store = store_of(arguments(["bronze", "--root", "x", "--kafka", "b:9092", "--topic", "sales", "--max-files", "5"]))
    assert (store.topic_format, store.topic, store.read_options) == ("kafka", "sales", {"maxFilesPerTrigger": 5})
    assert store.topic_options == {"kafka.bootstrap.servers": "b:9092", "startingOffsets": "earliest"}


def test_a_start_time_reaches_the_store():
    assert store_of(arguments(["bronze", "--root", "x"])).topic_start is None
    assert store_of(arguments(["bronze", "--root", "x", "--starting-time", "2024-05-01"])).topic_start == "2024-05-01"
