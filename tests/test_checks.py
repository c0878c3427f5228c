from decimal import Decimal

import pytest

from dwellmart.operators.checks import QualityError, export_types, null_counts, require_filled
from dwellmart.schemas import MART_SCHEMA


def mart(spark, **changes):
    row = {
        "county": "Cork", "year": 2020, "property_type": "House", "transaction_count": 1, "avg_price_eur": Decimal("1.5"),
        "median_price_eur": 1.5, "min_price_eur": Decimal(1), "max_price_eur": Decimal(2),
        "median_price_change_eur": None, "median_price_change_pct": None,
    }
    rows = [row, {**row, **changes}]
    return spark.createDataFrame([tuple(r[n] for n in MART_SCHEMA.names) for r in rows], MART_SCHEMA)


def test_complete_table_passes(spark):
    require_filled(mart(spark))


@pytest.mark.parametrize("column", ["county", "year", "transaction_count", "median_price_eur"])
def test_null_in_a_required_column_is_named(spark, column):
    with pytest.raises(QualityError, match=column):
        require_filled(mart(spark, **{column: None}))


def test_counts_come_from_one_aggregation(spark):
    frame = null_counts(mart(spark, county=None, year=None))
    assert {r.column_name: r.failures for r in frame.collect()} == {
        "county": 1, "year": 1, "transaction_count": 0, "median_price_eur": 0,
    }
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Scan") == plan.count("Exchange") == 1


def test_export_types(spark):
    kinds = dict(export_types(mart(spark)).dtypes)
    assert all(kinds[c] == "double" for c in ("avg_price_eur", "median_price_eur", "min_price_eur", "max_price_eur"))
    assert kinds["year"] == kinds["transaction_count"] == "bigint"
    assert export_types(mart(spark)).columns == MART_SCHEMA.names


def test_export_of_a_null_whole_number_fails(spark):
    with pytest.raises(Exception, match="year is NULL"):
        export_types(mart(spark, year=None)).collect()
