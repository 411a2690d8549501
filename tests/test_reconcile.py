from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import D, by_key, rows
from opsflow.plans import reconcile

D0, D1 = date(2024, 1, 1), date(2024, 1, 31)
AP = (
    "invoice_number string, vendor_id string, po_number string, invoice_date date, due_date date,"
    " line_amount decimal(18,2), tax_amount decimal(18,2), posting_status string"
)
GL = (
    "invoice_number string, vendor_id string, po_number string, gl_posting_date date, payment_due_date date,"
    " net_amount decimal(18,2), tax_amount decimal(18,2), gross_amount decimal(18,2), approval_status string,"
    " payment_status string"
)
VENDORS = "vendor_id string, vendor_name string, vendor_category string, payment_terms string"


def ap(number, amount, tax="0", vendor="V", when=D0, due=D1, status="POSTED"):
    return (number, vendor, "PO", when, due, D(amount), D(tax), status)


def gl(number, amount, tax="0", vendor="V", when=D0, due=D1, status="APPROVED"):
    return (number, vendor, "PO", when, due, D(amount), D(tax), D(amount) + D(tax), status, "OPEN")


def classify(spark, ap_rows, gl_rows, vendors=(("V", "Vendor", "C", "NET30"),)):
    return reconcile.classified(
        spark.createDataFrame(ap_rows, AP), spark.createDataFrame(gl_rows, GL), spark.createDataFrame(list(vendors), VENDORS), D0, D1
    )


def test_every_type_and_bound(spark):
    left = [
        ap("match", "10"),
        ap("cent", "10"),
        ap("two-cents", "10"),
        ap("lines", "5"), ap("lines", "5"),
        ap("tax", "10", "1"),
        ap("only-ap", "1500"),
        ap("thousand", "10"),
        ap("ten-thousand", "10"),
        ap("zero", "0"),
        ap("void", "10", status="VOIDED"),
        ap("no-status", "10", status=None),
        ap("late", "10", when=date(2024, 2, 1)),
    ]
    right = [
        gl("match", "10"),
        gl("cent", "10.01"),
        gl("two-cents", "10.02"),
        gl("lines", "10"),
        gl("tax", "9", "2"),
        gl("only-gl", "7"),
        gl("thousand", "1010"),
        gl("ten-thousand", "10010"),
        gl("zero", "5"),
        gl("refused", "10", status="REJECTED"),
        gl("no-status", "10", status=None),
    ]
    got = by_key(classify(spark, left, right), "invoice_number", "discrepancy_type", "variance_severity", "variance_pct")
    assert got == {
        "match": ("MATCHED", "NONE", 0.0),
        "cent": ("MATCHED", "NONE", 0.1),
        "two-cents": ("AMOUNT_MISMATCH", "LOW", 0.2),
        "lines": ("LINE_COUNT_MISMATCH", "NONE", 0.0),
        "tax": ("TAX_VARIANCE", "NONE", 0.0),
        "only-ap": ("MISSING_IN_ERP", "MEDIUM", -100.0),
        "only-gl": ("MISSING_IN_WMS", "LOW", None),
        "thousand": ("AMOUNT_MISMATCH", "MEDIUM", 10000.0),
        "ten-thousand": ("AMOUNT_MISMATCH", "HIGH", 100000.0),
        "zero": ("AMOUNT_MISMATCH", "LOW", None),
    }


def test_two_due_dates_multiply(spark):
    left = [ap("x", "10"), ap("x", "10", due=date(2024, 2, 15))]
    right = [gl("x", "10"), gl("x", "10", due=date(2024, 2, 20))]
    assert classify(spark, left, right).count() == 4


def test_unknown_and_null_vendors(spark):
    left = [ap("a", "5", vendor="nobody"), ap("b", "5", vendor=None)]
    right = [gl("b", "5", vendor=None), gl("c", "5")]
    found = classify(spark, left, right)
    assert rows(found, "invoice_number", "vendor_id", "vendor_name", "discrepancy_type") == [
        ("a", "nobody", None, "MISSING_IN_ERP"),
        ("b", None, None, "MISSING_IN_ERP"),
        ("b", None, None, "MISSING_IN_WMS"),
        ("c", "V", "Vendor", "MISSING_IN_WMS"),
    ]
    # The summary keeps the NULL vendor, the exception report cannot join it.
    assert by_key(reconcile.vendor_summary(found), "vendor_id", "exception_count") == {"nobody": 1, None: 2, "V": 1}
    report = reconcile.exception_report(found)
    assert {r["vendor_id"] for r in report.collect()} == {"nobody", "V"}
    assert len(report.columns) == 19


def test_summary_rates_and_order(spark):
    left = [ap("a", "10"), ap("b", "10"), ap("c", "10", vendor="W")]
    right = [gl("a", "10"), gl("b", "2010"), gl("c", "10", vendor="W")]
    summary = reconcile.reconciliation_vendor_summary(
        spark.createDataFrame(left, AP), spark.createDataFrame(right, GL), spark.createDataFrame([("V", "v", "c", "t")], VENDORS), D0, D1
    )
    assert [(r["vendor_id"], r["exception_rate_pct"], r["total_abs_variance_usd"]) for r in summary.collect()] == [
        ("V", 50.0, 2000.0),
        ("W", 0.0, 0.0),
    ]


def test_report_order(spark):
    left = [ap("low", "10"), ap("none", "5"), ap("none", "5"), ap("high", "10"), ap("mid", "10")]
    right = [gl("low", "11"), gl("none", "10"), gl("high", "20010"), gl("mid", "2010")]
    report = reconcile.reconciliation_exceptions(
        spark.createDataFrame(left, AP), spark.createDataFrame(right, GL), spark.createDataFrame([("V", "v", "c", "t")], VENDORS), D0, D1
    )
    assert [r["invoice_number"] for r in report.collect()] == ["high", "mid", "low", "none"]


@pytest.mark.parametrize("gross, wanted", [("10000", "HIGH"), ("-10000", "HIGH"), ("9999.99", "MEDIUM"), ("1000", "MEDIUM"), ("0.02", "LOW"), ("0.01", "NONE"), ("0", "NONE")])
def test_severity_bounds(spark, gross, wanted):
    df = spark.createDataFrame([(D(gross),)], "g decimal(18,2)")
    assert df.select(reconcile.variance_severity(F.col("g"))).first()[0] == wanted
