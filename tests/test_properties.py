"""Properties that hold for any input, on generated rows."""

from datetime import date, datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dwellmart.operators.first_copy import first_copy
from dwellmart.operators.insert_only import unseen_rows
from dwellmart.schemas import ARRIVAL_ORDER, SALE_KEY, SILVER_SCHEMA
from dwellmart.session import shared_folder
from dwellmart.streaming.silver import SilverTable

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.tuples(
    st.sampled_from(["A", "B", "C", None]),
    st.sampled_from([date(2020, 1, 1), date(2021, 1, 1), None]),
    st.sampled_from([Decimal("1.00"), Decimal("2.00"), None]),
)
batches = st.lists(keys, min_size=1, max_size=30)


def frame(spark, rows):
    full = [
        (day, address, "Cork", "", price, False, False, "House", "", "k", "t", 0, i, datetime(2024, 1, 1), None)
        for i, (address, day, price) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SILVER_SCHEMA)


@FEW
@given(rows=batches)
def test_first_copy_keeps_each_key_once(spark, rows):
    got = first_copy(frame(spark, rows), SALE_KEY, ARRIVAL_ORDER).collect()
    assert sorted((r._kafka_offset for r in got)) == sorted({key: rows.index(key) for key in rows}.values())


@FEW
@given(old=batches, new=batches)
def test_unseen_rows_match_brute_force(spark, old, new):
    fresh = first_copy(frame(spark, new), SALE_KEY, ARRIVAL_ORDER)
    target = frame(spark, old)
    held = set(old)
    plain = {(r.address, r.date_of_sale, r.price_eur) for r in unseen_rows(fresh, target, SALE_KEY).collect()}
    safe = {(r.address, r.date_of_sale, r.price_eur) for r in unseen_rows(fresh, target, SALE_KEY, True).collect()}
    assert plain == {key for key in new if None in key or key not in held}
    assert safe == set(new) - held


@FEW
@given(first=batches, second=batches)
def test_upsert_of_the_same_rows_again_adds_no_full_key(spark, first, second):
    silver = SilverTable(spark, shared_folder(spark, "property"), buckets=3)
    for batch_id, rows in enumerate((first, second, first, second)):
        silver.upsert(frame(spark, rows), "q", batch_id)
    stored = [(r.address, r.date_of_sale, r.price_eur) for r in silver.read(spark).collect()]
    full = [key for key in stored if None not in key]
    assert sorted(full) == sorted({key for key in first + second if None not in key})
    assert len(stored) - len(full) == 2 * sum(len({k for k in rows if None in k}) for rows in (first, second))
