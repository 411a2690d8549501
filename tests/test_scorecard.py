from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import D, by_key, plan, rows
from opsflow.plans import scorecard

AS_OF = date(2024, 5, 15)
PO = (
    "po_id int, supplier_id int, po_date date, promised_delivery_date date, actual_delivery_date date,"
    " ordered_qty decimal(18,4), received_qty decimal(18,4), unit_price_ordered decimal(18,4),"
    " unit_price_invoiced decimal(18,4), line_status string"
)


def line(po, supplier, when=date(2024, 5, 1), late=0, ordered=10, received=10, price=100, invoiced=100, status="CLOSED"):
    promised = when + timedelta(days=10)
    actual = None if late is None else promised + timedelta(days=late)
    return (po, supplier, when, promised, actual, D(ordered), D(received), D(price), D(invoiced), status)


def measures(spark, lines):
    df = spark.createDataFrame(lines, PO)
    return scorecard.supplier_measures(scorecard.recent_lines(df, AS_OF), AS_OF)


def test_null_delivery_counts_as_late_but_not_as_a_delay(spark):
    got = measures(spark, [line(1, 1, late=None), line(2, 1, late=0), line(3, 1, late=4), line(3, 1, late=5)]).first()
    assert (got["on_time_delivery_pct"], got["avg_delay_days_when_late"], got["max_delay_days"]) == (25.0, 4.5, 5)
    assert (got["total_pos"], got["total_line_items"]) == (3, 4)


def test_zero_price_is_left_out_of_the_average(spark):
    got = measures(spark, [line(1, 1, price=0, invoiced=5), line(2, 1, price=100, invoiced=101)]).first()
    assert (got["avg_price_variance_pct"], got["accurate_invoice_lines"]) == (1.0, 1)
    assert got["total_invoice_variance_usd"] == 60


def test_zero_order_quantity_gives_no_fill_rate(spark):
    assert measures(spark, [line(1, 1, ordered=0, received=0)]).first()["fill_rate_pct"] is None


def test_filters(spark):
    lines = [
        line(1, 1, status="OPEN"),
        line(2, 2, when=date(2023, 5, 14)),
        line(3, 3, when=date(2023, 5, 15)),
        line(4, 4, status="INVOICED"),
    ]
    assert set(by_key(measures(spark, lines), "supplier_id", "total_pos")) == {3, 4}


def test_prior_window_is_six_months_and_half_open(spark):
    lines = [
        line(1, 1, when=date(2024, 4, 1), late=0),
        line(2, 1, when=date(2024, 3, 31), late=1),
        line(3, 1, when=date(2023, 10, 1), late=0),
        line(4, 1, when=date(2023, 9, 30), late=0),
    ]
    got = measures(spark, lines).first()
    assert (got["otd_pct_current_qtr"], got["otd_pct_prior_qtr"]) == (100.0, 50.0)


RECEIPTS = (
    "grn_id int, supplier_id int, receipt_date date, received_qty decimal(18,4), accepted_qty decimal(18,4),"
    " rejected_qty decimal(18,4)"
)


def test_receipt_quality_counts_a_receipt_once(spark):
    data = [
        (1, 1, AS_OF, D(10), D(9), D(1)),
        (1, 1, AS_OF, D(10), D(9), D(1)),
        (2, 1, AS_OF, D(20), D(20), D(0)),
        (3, 2, AS_OF, D(5), D(5), D(0)),
        (4, 3, date(2023, 5, 14), D(5), D(0), D(5)),
    ]
    got = by_key(
        scorecard.receipt_quality(spark.createDataFrame(data, RECEIPTS), AS_OF),
        "supplier_id",
        "total_receipts",
        "defect_rate_pct",
        "shipments_with_defects",
    )
    assert got == {1: (3, 5.0, 1), 2: (1, 0.0, 0)}


def suppliers(spark, ids):
    return spark.createDataFrame(
        [(i, f"s{i}", "T1" if i < 4 else "T2", "X") for i in ids],
        "supplier_id int, supplier_name string, supplier_tier string, country_of_origin string",
    )


def test_card(spark):
    lines = [
        line(1, 1),
        line(2, 2),
        line(3, 3, ordered=0, received=0),
        line(4, 4, when=date(2023, 12, 1), late=3, received=5, invoiced=104),
        line(5, 5, late=9, received=1, invoiced=200),
        line(6, 99),
    ]
    receipts = spark.createDataFrame([(1, 4, AS_OF, D(10), D(0), D(10))], RECEIPTS)
    card = scorecard.supplier_scorecard(
        spark.createDataFrame(lines, PO), receipts, suppliers(spark, [1, 2, 3, 4, 5]), AS_OF
    )
    assert len(card.columns) == 18
    got = by_key(card, "supplier_id", "composite_score", "supplier_status", "rank_within_tier", "performance_quartile")
    assert got[1] == (100.0, "PREFERRED", 2, "Top 25%")
    assert got[2] == (100.0, "PREFERRED", 2, "Upper Mid")
    # No score: sorts first and ranks 1, yet has the lowest status.
    assert got[3] == (None, "AT RISK", 1, "Top 25%")
    # 0.25 * 50 + 0.20 * 60, no on-time line, every receipt rejected.
    assert got[4] == (24.5, "AT RISK", 1, "Lower Mid")
    assert got[5] == (22.5, "AT RISK", 2, "Bottom 25%")
    extra = by_key(card, "supplier_id", "defect_rate_pct", "otd_pct_current_qtr", "otd_qtr_delta")
    assert extra[1] == (0.0, 100.0, 0.0)
    assert extra[4] == (100.0, None, None)
    assert [r["supplier_id"] for r in card.collect()][0] == 3


@pytest.mark.parametrize("score, wanted", [(90.0, "PREFERRED"), (89.9, "APPROVED"), (75.0, "APPROVED"), (74.9, "CONDITIONAL"), (60.0, "CONDITIONAL"), (59.9, "AT RISK"), (None, "AT RISK")])
def test_status(spark, score, wanted):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(scorecard.status(F.col("s"))).first()[0] == wanted


def test_null_price_variance_gives_no_score(spark):
    df = spark.createDataFrame([(100.0, 100.0, None, 0.0)], "o double, f double, p double, d double")
    assert df.select(scorecard.composite_score(*[F.col(c) for c in "ofpd"])).first()[0] is None


def test_line_measures_share_one_aggregate(spark):
    df = spark.createDataFrame([line(1, 1)], PO)
    text = plan(scorecard.supplier_measures(scorecard.recent_lines(df, AS_OF), AS_OF))
    # The distinct count runs on its own: nothing expands the measures per distinct column.
    assert "Expand" not in text


def test_orders_are_counted_apart_and_only_where_asked(spark, tmp_path):
    spark.createDataFrame([line(i % 3, i) for i in range(9)] + [line(None, 2), line(2, None)], PO).write.parquet(str(tmp_path / "po"))
    lines = scorecard.recent_lines(spark.read.parquet(str(tmp_path / "po")), AS_OF)
    counted = scorecard.supplier_measures(lines, AS_OF)
    plain = scorecard.supplier_measures(lines, AS_OF, count_orders=False)
    # Without the count one row a supplier and task is shuffled, and orders are not even read.
    text, texts = plan(plain), plan(counted)
    assert text.count("Exchange hashpartitioning") == 1 and "hashpartitioning(supplier_id" in text and "po_id" not in text
    # With it, what is shuffled by order are the two columns alone.
    wide = [part.split(")")[0] for part in texts.split("Exchange hashpartitioning(")[1:]]
    assert sum("po_id" in part for part in wide) == 1
    assert "total_pos" not in plain.columns and rows(plain) == rows(counted.drop("total_pos"))
