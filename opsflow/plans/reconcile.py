"""Invoice reconciliation of two ledgers: exceptions and vendor summary."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.functions.dates import day
from opsflow.functions.numeric import ratio_of_sums
from opsflow.operators.joins import lookup
from opsflow.session import staged

# Excluded states, tolerance and severity bounds.
VOID_STATUS = "VOIDED"
REFUSED_STATUSES = ("REJECTED", "CANCELLED")
TOLERANCE = "0.01"
HIGH_BOUND, MEDIUM_BOUND = 10000, 1000
SEVERITY_ORDER = ("HIGH", "MEDIUM", "LOW")
MONEY = "decimal(38,4)"


def wms_invoices(lines: DataFrame, start: date, end: date) -> DataFrame:
    """Payables lines rolled up to invoices; void lines and lines without a status drop out."""
    kept = lines.where(F.col("invoice_date").between(day(start), day(end)) & (F.col("posting_status") != VOID_STATUS))
    return kept.groupBy("invoice_number", "vendor_id", "po_number", "invoice_date", "due_date").agg(
        F.sum("line_amount").cast(MONEY).alias("total_amount"),
        F.sum("tax_amount").cast(MONEY).alias("tax_amount"),
        (F.sum("line_amount").cast(MONEY) + F.sum("tax_amount").cast(MONEY)).cast(MONEY).alias("gross_amount"),
        F.count("*").alias("line_count"),
        F.max("posting_status").alias("posting_status"),
    )


def erp_invoices(lines: DataFrame, start: date, end: date) -> DataFrame:
    """General-ledger lines rolled up to invoices; refused lines and lines without a status drop out."""
    kept = lines.where(
        F.col("gl_posting_date").between(day(start), day(end)) & ~F.col("approval_status").isin(*REFUSED_STATUSES)
    )
    return kept.groupBy(
        "invoice_number",
        "vendor_id",
        "po_number",
        F.col("gl_posting_date").alias("invoice_date"),
        F.col("payment_due_date").alias("due_date"),
    ).agg(
        F.sum("net_amount").cast(MONEY).alias("total_amount"),
        F.sum("tax_amount").cast(MONEY).alias("tax_amount"),
        F.sum("gross_amount").cast(MONEY).alias("gross_amount"),
        F.count("*").alias("line_count"),
        F.max("approval_status").alias("approval_status"),
        F.max("payment_status").alias("payment_status"),
    )


def reconciled(wms: DataFrame, erp: DataFrame) -> DataFrame:
    """Both roll-ups side by side on (invoice, vendor), with presence flags and variances.

    Invoices that differ only in order, date or due date share the key and pair
    with each other, as in any outer join.
    """
    # Both sides are already rolled up by more than this key, so it has no hot values to split.
    keys = ("invoice_number", "vendor_id")
    left, right = (r.select([F.col(c).alias(f"{p}_{c}") for c in r.columns]) for p, r in (("l", wms), ("r", erp)))
    both = left.join(right, [F.col(f"l_{k}") == F.col(f"r_{k}") for k in keys], "full_outer")

    def variance(column: str) -> Column:
        zero = F.lit(0)
        return F.coalesce(F.col(f"r_{column}"), zero) - F.coalesce(F.col(f"l_{column}"), zero)

    return both.select(
        *[F.coalesce(f"l_{c}", f"r_{c}").alias(c) for c in ("invoice_number", "vendor_id", "po_number", "invoice_date")],
        F.col("l_gross_amount").alias("wms_gross_amount"),
        F.col("r_gross_amount").alias("erp_gross_amount"),
        F.col("l_posting_status").alias("wms_posting_status"),
        F.col("r_approval_status").alias("erp_approval_status"),
        F.col("r_payment_status").alias("erp_payment_status"),
        F.col("l_invoice_number").isNotNull().cast("int").alias("in_wms"),
        F.col("r_invoice_number").isNotNull().cast("int").alias("in_erp"),
        variance("gross_amount").alias("gross_amount_variance"),
        variance("tax_amount").alias("tax_variance"),
        variance("line_count").alias("line_count_variance"),
    )


def discrepancy_type(in_wms: Column, in_erp: Column, gross: Column, lines: Column, tax: Column) -> Column:
    present = (in_wms == 1) & (in_erp == 1)
    limit = F.lit(TOLERANCE).cast("decimal(4,2)")
    return (
        F.when((in_wms == 1) & (in_erp == 0), "MISSING_IN_ERP")
        .when((in_wms == 0) & (in_erp == 1), "MISSING_IN_WMS")
        .when(present & (F.abs(gross) > limit), "AMOUNT_MISMATCH")
        .when(present & (lines != 0), "LINE_COUNT_MISMATCH")
        .when(present & (F.abs(tax) > limit), "TAX_VARIANCE")
        .otherwise("MATCHED")
    )


def variance_severity(gross: Column) -> Column:
    size = F.abs(gross)
    return (
        F.when(size >= HIGH_BOUND, "HIGH")
        .when(size >= MEDIUM_BOUND, "MEDIUM")
        .when(size > F.lit(TOLERANCE).cast("decimal(4,2)"), "LOW")
        .otherwise("NONE")
    )


def classified(
    ap_lines: DataFrame, gl_lines: DataFrame, vendors: DataFrame, start: date, end: date
) -> DataFrame:
    """Every reconciled invoice with vendor data, discrepancy type, severity and variance %.

    Each ledger's lines are scanned once, and each roll-up is shuffled once for the join.
    """
    rows = reconciled(wms_invoices(ap_lines, start, end), erp_invoices(gl_lines, start, end))
    named = lookup(
        rows,
        vendors.select("vendor_id", "vendor_name", "vendor_category", "payment_terms"),
        {"vendor_id": "vendor_id"},
        "left",
    )
    gross, wms_gross = F.col("gross_amount_variance"), F.col("wms_gross_amount")
    return named.withColumns(
        {
            "discrepancy_type": discrepancy_type(
                F.col("in_wms"), F.col("in_erp"), gross, F.col("line_count_variance"), F.col("tax_variance")
            ),
            "variance_severity": variance_severity(gross),
            "variance_pct": ratio_of_sums(gross, wms_gross),
        }
    )


def vendor_summary(invoices: DataFrame) -> DataFrame:
    """Counts, exception rate and total absolute variance per vendor."""
    is_match = F.col("discrepancy_type") == "MATCHED"
    sums = invoices.groupBy("vendor_id", "vendor_name", "vendor_category").agg(
        F.count("*").alias("total_invoices"),
        F.count_if(is_match).alias("matched_count"),
        F.count_if(~is_match).alias("exception_count"),
        F.sum(F.abs("gross_amount_variance")).alias("total_abs_variance"),
    )
    return sums.withColumn(
        "exception_rate_pct", ratio_of_sums(F.col("exception_count"), F.col("total_invoices"))
    ).withColumn("total_abs_variance_usd", F.round("total_abs_variance", 2).cast("decimal(38,2)"))


def exception_report(invoices: DataFrame) -> DataFrame:
    """Exceptions with their vendor's figures, most severe and largest first.

    ``invoices`` feeds both sides, so it should be a stored table. Rows without a
    vendor find no summary row and drop out.
    """
    figures = vendor_summary(invoices).select(
        F.col("vendor_id"),
        F.col("exception_rate_pct").alias("vendor_exception_rate"),
        F.col("total_abs_variance").alias("vendor_total_variance_usd"),
    )
    exceptions = invoices.where(F.col("discrepancy_type") != "MATCHED")
    place = F.coalesce(
        F.nullif(F.array_position(F.array(*[F.lit(s) for s in SEVERITY_ORDER]), F.col("variance_severity")), F.lit(0)),
        F.lit(len(SEVERITY_ORDER) + 1),
    )
    return (
        lookup(exceptions, figures, {"vendor_id": "vendor_id"})
        .orderBy(place, F.abs("gross_amount_variance").desc_nulls_first(), "invoice_number", "vendor_id")
        .select(
            "invoice_number",
            "vendor_id",
            "vendor_name",
            "vendor_category",
            "po_number",
            "invoice_date",
            "discrepancy_type",
            "variance_severity",
            "wms_gross_amount",
            "erp_gross_amount",
            "gross_amount_variance",
            "variance_pct",
            "tax_variance",
            F.col("line_count_variance").cast("bigint").alias("line_count_variance"),
            "wms_posting_status",
            "erp_approval_status",
            "erp_payment_status",
            "vendor_exception_rate",
            "vendor_total_variance_usd",
        )
    )


def reconciliation_exceptions(
    ap_lines: DataFrame, gl_lines: DataFrame, vendors: DataFrame, start: date, end: date
) -> DataFrame:
    """Exception report; the classified invoices are written once and read by both branches."""
    return exception_report(staged(classified(ap_lines, gl_lines, vendors, start, end), "classified"))


def reconciliation_vendor_summary(
    ap_lines: DataFrame, gl_lines: DataFrame, vendors: DataFrame, start: date, end: date
) -> DataFrame:
    """Vendor summary, largest total variance first."""
    rows = vendor_summary(classified(ap_lines, gl_lines, vendors, start, end))
    return rows.orderBy(F.col("total_abs_variance_usd").desc_nulls_first(), "vendor_id").select(
        "vendor_id",
        "vendor_name",
        "vendor_category",
        "total_invoices",
        "matched_count",
        "exception_count",
        "exception_rate_pct",
        "total_abs_variance_usd",
    )
