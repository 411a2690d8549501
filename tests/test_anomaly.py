from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import D, by_key, rows
from opsflow.operators.rolling import fill_missing_days
from opsflow.plans import anomaly

SERIES = "sku_id int, warehouse_id string, transaction_date date, daily_qty decimal(28,4)"
START = date(2024, 1, 1)


def series(spark, quantities, sku=1, gaps=()):
    days = [d for d in range(len(quantities) + len(gaps)) if d not in gaps]
    return spark.createDataFrame(
        [(sku, "W", START + timedelta(days=d), None if q is None else D(str(q))) for d, q in zip(days, quantities)], SERIES
    )


def scored(spark, quantities, *columns, **kwargs):
    df = anomaly.scored(series(spark, quantities, **kwargs)).orderBy("transaction_date")
    return [tuple(r) for r in df.select(*columns).collect()]


def test_first_row_and_constant_series_score_zero(spark):
    assert scored(spark, [5, 5, 5], "z_score", "dod_pct_change") == [(0.0, None), (0.0, 0.0), (0.0, 0.0)]


def test_z_and_changes(spark):
    got = scored(spark, [10, 20], "rolling_avg", "z_score", "dod_pct_change", "wow_pct_change")
    assert got[1] == (15.0, 0.71, 100.0, None)


def test_change_against_zero_is_null(spark):
    assert scored(spark, [0, 20], "dod_pct_change") == [(None,), (None,)]


def test_week_over_week_counts_rows_not_days(spark):
    # Seven rows back lies eight days back when a day is missing.
    got = scored(spark, [100, 1, 2, 3, 4, 5, 6, 150], "transaction_date", "wow_pct_change", gaps=(3,))
    assert got[-1] == (START + timedelta(days=8), 50.0)


def test_zero_z_has_no_sign(spark):
    assert all(str(z) == "0.0" for (z,) in scored(spark, [3, 3, 3], "z_score"))


def test_frame_without_the_current_row_can_reach_critical(spark):
    quiet = series(spark, [10, 11, 10, 11, 10, 11, 10, 60])
    last = START + timedelta(days=7)

    def z(flag):
        return anomaly.scored(quiet, exclude_current=flag).where(F.col("transaction_date") == F.lit(last)).first()["z_score"]

    assert z(False) < 3 <= z(True)


@settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 10_000), min_size=2, max_size=20))
def test_z_is_bounded_by_the_frame(spark, quantities):
    # (n - 1) / sqrt(n) for a sample of n = 7 that holds the value itself.
    assert all(abs(z) <= 2.27 for (z,) in scored(spark, quantities, "z_score"))


@pytest.mark.parametrize(
    "z, dod, qty, wanted, why",
    [
        (3.0, None, 100, "CRITICAL", "extreme"),
        (-3.0, None, 100, "CRITICAL", "extreme"),
        (2.0, None, 100, "HIGH", "deviation"),
        (1.5, None, 100, "MEDIUM", "normal"),
        (1.49, 50.0, 100, "HIGH", "normal"),
        (0.0, -50.0, 100, "HIGH", "drop"),
        (0.0, 100.0, 100, "HIGH", "spike"),
        (0.0, 49.99, 100, "NORMAL", "normal"),
        (0.0, None, 100, "NORMAL", "normal"),
        (0.0, None, 10, "MEDIUM", "reorder"),
        (0.0, None, 9, "HIGH", "safety"),
        (0.0, None, 20, "NORMAL", "normal"),
        (0.0, -60.0, 15, "HIGH", "reorder"),
    ],
)
def test_severity_and_reason(spark, z, dod, qty, wanted, why):
    df = spark.createDataFrame([(z, dod, qty, 10, 20)], "z double, dod double, qty int, safety int, reorder int")
    facts = [F.col(c) for c in ("z", "dod", "qty", "safety", "reorder")]
    got = df.select(anomaly.severity(*facts), anomaly.reason(*facts)).first()
    assert tuple(got) == (wanted, anomaly.REASONS[why])


def test_report_ties_unknown_skus_and_totals(spark):
    day = START + timedelta(days=1)
    moves = spark.createDataFrame(
        [(sku, wh, d, D(q), D(0), D(0)) for sku, wh in [(1, "W1"), (2, "W1"), (3, "W2"), (9, "W1")] for d, q in [(START, 10), (day, 30)]],
        "sku_id int, warehouse_id string, transaction_date date, quantity_on_hand decimal(18,4),"
        " quantity_received decimal(18,4), quantity_shipped decimal(18,4)",
    )
    skus = spark.createDataFrame(
        [(s, f"n{s}", "C", D(2), 5, 1) for s in (1, 2, 3)],
        "sku_id int, sku_name string, category string, unit_cost decimal(18,4), reorder_point int, safety_stock int",
    )
    report = anomaly.inventory_anomaly_report(moves, skus, day)
    got = by_key(report, "sku_id", "rank_in_category", "estimated_variance_usd", "warehouse_total_variance_usd")
    assert got == {1: (1, 20.0, 40.0), 2: (2, 20.0, 40.0), 3: (3, 20.0, 20.0)}
    assert len(report.columns) == 17


def test_lookback_start_is_included(spark):
    as_of = date(2024, 4, 1)
    moves = spark.createDataFrame(
        [(1, "W", as_of - timedelta(days=n), D(1), D(0), D(0)) for n in (90, 91)],
        "sku_id int, warehouse_id string, transaction_date date, quantity_on_hand decimal(18,4),"
        " quantity_received decimal(18,4), quantity_shipped decimal(18,4)",
    )
    assert anomaly.daily_inventory(moves, as_of).count() == 1
    assert anomaly.daily_inventory(moves, as_of, None).count() == 2


def test_missing_days_are_filled_with_null(spark):
    dense = fill_missing_days(series(spark, [1, 2], gaps=(1,)), anomaly.SERIES, "transaction_date", "daily_qty")
    assert [r["daily_qty"] for r in dense.orderBy("transaction_date").collect()] == [D(1), None, D(2)]
    assert rows(dense.groupBy().count()) == [(3,)]
