from decimal import Decimal

import pytest

from dwellmart.operators.county_map import weighted_median_by_county, with_coordinates
from dwellmart.operators.selection import at_latest_year, choices, choose, default_counties, nothing_chosen, some_chosen, NOTHING_CHOSEN
from dwellmart.plans import panels
from dwellmart.schemas import MART_SCHEMA
from dwellmart.sources.counties import COUNTY_COORDINATES, county_coordinates


def mart(spark, *rows):
    """Rows of ``county, year, property_type, transaction_count, median, change in percent``."""
    full = [(c, y, t, n, Decimal(1), m, Decimal(1), Decimal(1), None, pct) for c, y, t, n, m, pct in rows]
    return spark.createDataFrame(full, MART_SCHEMA)


@pytest.fixture
def sample(spark):
    return mart(
        spark,
        ("Dublin", 2020, "House", 10, 300000.0, 4.25),
        ("Dublin", 2021, "House", 30, 312500.5, None),
        ("Dublin", 2021, "Flat", 10, 200000.0, -2.15),
        ("Cork", 2021, "House", 5, 100.0, 1.0),
        ("Cork", 2022, "House", 5, 110.0, 10.0),
        ("Narnia", 2021, "House", 5, 90.0, None),
        (None, 2021, "House", 5, 80.0, None),
        ("Mayo", None, "House", 5, 70.0, None),
    )


def test_served_frame_has_the_types_and_order_of_its_users(spark):
    rows = mart(spark, ("Mayo", 2021, "House", 5, 90.0, None), ("Cork", 2022, "House", 5, 110.0, 10.0), ("Cork", 2021, "House", 5, 100.0, 1.0))
    served = panels.price_summary(rows)
    kinds = dict(served.dtypes)
    assert {kinds[c] for c in ("avg_price_eur", "median_price_eur", "min_price_eur", "max_price_eur")} == {"double"}
    assert kinds["year"] == kinds["transaction_count"] == "bigint"
    assert [(r.county, r.year) for r in served.collect()] == [("Cork", 2021), ("Cork", 2022), ("Mayo", 2021)]
    assert dict(panels.underlying_table(served).dtypes) == kinds


def test_choose(sample):
    assert choose(sample, ["Dublin"], ["Flat"]).count() == 1
    assert choose(sample).count() == 7
    assert choose(sample, []).count() == 0
    assert nothing_chosen(choose(sample, ["Atlantis"])) and not nothing_chosen(choose(sample, ["Cork"]))


def test_latest_year_is_that_of_the_choice(sample):
    assert {r.year for r in at_latest_year(choose(sample, ["Dublin"])).collect()} == {2021}
    assert {r.year for r in at_latest_year(choose(sample, ["Cork", "Dublin"])).collect()} == {2022}
    assert at_latest_year(choose(sample, ["Mayo"])).isEmpty()


def test_choices_are_sorted_without_null(sample):
    assert [r.county for r in choices(sample, "county").collect()] == ["Cork", "Dublin", "Mayo", "Narnia"]


def defaults(frame, *args):
    return [r.county for r in default_counties(frame, *args).orderBy("position").collect()]


def test_default_counties(spark, sample):
    assert defaults(sample) == ["Dublin", "Cork"]
    assert defaults(sample, ["Nowhere", "Elsewhere"]) == ["Cork", "Dublin", "Mayo"]
    assert defaults(sample, ["Mayo", "Nowhere", "Cork", "Dublin", "Narnia"]) == ["Mayo", "Cork", "Dublin", "Narnia"]
    assert defaults(sample, ["A", "B", "C", "D", "E"]) == ["Cork", "Dublin", "Mayo"]
    assert defaults(sample.limit(0)) == []


def test_headline_metrics_for_one_county_only(sample):
    got = {r.label: (r.county, r.year, r.value, r.delta) for r in panels.headline_metrics(sample, ["Dublin"]).collect()}
    assert got == {
        "House": ("Dublin", 2021, "€312,500", "first year on record"),
        "Flat": ("Dublin", 2021, "€200,000", "-2.1% YoY"),
    }
    assert panels.headline_metrics(sample, ["Dublin", "Cork"]) is None
    assert panels.headline_metrics(sample, []) is None


def test_trend_and_table(sample):
    assert panels.trend_series(sample, ["Dublin"], ["House"]).columns == ["year", "median_price_eur", "county", "property_type"]
    got = [(r.county, r.property_type, r.year) for r in panels.underlying_table(sample, ["Dublin", "Cork"]).collect()]
    assert got == [
        ("Cork", "House", 2021), ("Cork", "House", 2022), ("Dublin", "Flat", 2021), ("Dublin", "House", 2020), ("Dublin", "House", 2021),
    ]


def test_weighted_median(spark):
    rows = mart(
        spark, ("Dublin", 2021, "House", 30, 300.0, None), ("Dublin", 2021, "Flat", 10, 100.0, None),
        ("Cork", 2021, "House", 5, None, None), (None, 2021, "House", 5, 1.0, None),
        ("Mayo", 2021, "House", 2, 10.0, None), ("Mayo", 2021, "Flat", 2, None, None),
    )
    got = {r.county: tuple(r)[1:] for r in weighted_median_by_county(rows).collect()}
    # Sales of a group without a median still weigh in.
    assert got == {"Dublin": (10000.0, 40, 250.0), "Cork": (None, 5, None), "Mayo": (20.0, 4, 5.0)}


def test_map_keeps_counties_with_a_place(spark, sample):
    got = {r.county: (r.weighted_median_price_eur, r.lat, r.lon) for r in panels.map_dataset(sample, ["Dublin", "Narnia"]).collect()}
    assert got == {"Dublin": ((312500.5 * 30 + 200000.0 * 10) / 40, 53.35, -6.26)}
    assert panels.map_dataset(sample).columns == [
        "county", "_weighted_price_sum", "total_transactions", "weighted_median_price_eur", "lat", "lon",
    ]


def test_coordinates_join_as_a_broadcast(spark, sample):
    assert county_coordinates(spark).count() == len(COUNTY_COORDINATES) == 26
    plan = with_coordinates(weighted_median_by_county(sample), county_coordinates(spark))._jdf.queryExecution()
    assert "BroadcastHashJoin" in plan.executedPlan().toString()
    assert "Inner" in plan.executedPlan().toString()


def test_latest_year_filters_the_scan(spark, folder, sample):
    sample.write.parquet(folder)
    plan = at_latest_year(choose(spark.read.parquet(folder), ["Dublin"]))._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "Join" not in plan
    assert "In(county" in plan or "EqualTo(county" in plan


def test_a_choice_without_rows_fails_in_its_own_run(sample):
    some, none = choose(sample, ["Cork"]), choose(sample, ["Atlantis"])
    assert some_chosen(some).exceptAll(some).isEmpty() and some_chosen(some).count() == some.count()
    with pytest.raises(Exception, match=NOTHING_CHOSEN):
        some_chosen(none).collect()
    with pytest.raises(Exception, match=NOTHING_CHOSEN):
        some_chosen(none).select("county").orderBy("county").collect()
