"""Supplier scorecard: delivery, price, quality and trend measures, score, rank, quartile."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.context import months_back, quarter_start
from opsflow.functions.dates import day
from opsflow.functions.numeric import floor_at_zero, mean, ratio, ratio_of_sums, round_half_up
from opsflow.operators.ranking import ntile_at_scale, rank_at_scale
from opsflow.session import staged

# Counted line states, weights, status bounds and quartile labels.
COUNTED_STATUSES = ("RECEIVED", "INVOICED", "CLOSED")
WEIGHTS = {"on_time": 0.35, "fill": 0.25, "price": 0.20, "quality": 0.20}
STATUS_BOUNDS = ((90, "PREFERRED"), (75, "APPROVED"), (60, "CONDITIONAL"))
LOWEST_STATUS = "AT RISK"
QUARTILE_LABELS = ("Top 25%", "Upper Mid", "Lower Mid", "Bottom 25%")


def recent_lines(orders: DataFrame, as_of: date, months: int = 12) -> DataFrame:
    """Counted order lines of the last ``months``, with delay days and the on-time flag.

    A line without an actual delivery date counts as late.
    """
    late = F.datediff("actual_delivery_date", "promised_delivery_date")
    return (
        orders.where(F.col("po_date") >= day(months_back(as_of, months)))
        .where(F.col("line_status").isin(*COUNTED_STATUSES))
        .withColumns(
            {
                "delay_days": late,
                "on_time": F.when(F.col("actual_delivery_date") <= F.col("promised_delivery_date"), 1).otherwise(0),
            }
        )
    )


def supplier_measures(lines: DataFrame, as_of: date, prior_months: int = 6, count_orders: bool = True) -> DataFrame:
    """Delivery, price and quarter measures per supplier.

    All sums combine inside the tasks that read the lines, so one row a supplier and task is
    shuffled. Only ``total_pos`` needs the orders themselves: with ``count_orders`` they are
    counted apart, from a second scan of their few columns; without it the column is left out.
    """
    ordered, invoiced = F.col("unit_price_ordered"), F.col("unit_price_invoiced")
    gap = invoiced - ordered
    # Per-line ratios are read as decimals so that their sum does not depend on the order of adding.
    gap_ratio = ratio(gap, ordered).cast("decimal(30,12)")
    start = quarter_start(as_of)
    this_quarter = F.col("po_date") >= day(start)
    prior = (F.col("po_date") >= day(months_back(start, prior_months))) & (F.col("po_date") < day(start))
    is_late = F.col("delay_days") > 0

    def on_time_pct(hits: str, rows: str) -> Column:
        return round_half_up(mean(F.col(hits), F.col(rows)) * 100, 2)

    sums = lines.groupBy("supplier_id").agg(
        F.count("*").alias("total_line_items"),
        F.count_if(F.abs(ratio(gap, ordered)) <= 0.01).alias("accurate_invoice_lines"),
        F.sum(gap_ratio).alias("gap_ratio_sum"),
        F.count(gap_ratio).alias("gap_ratio_n"),
        F.sum(gap * F.col("received_qty")).alias("total_invoice_variance_usd"),
        F.sum("ordered_qty").alias("total_ordered_qty"),
        F.sum("received_qty").alias("total_received_qty"),
        F.sum("on_time").alias("on_time_lines"),
        F.sum(F.when(is_late, F.col("delay_days"))).alias("late_days"),
        F.count_if(is_late).alias("late_lines"),
        F.max("delay_days").alias("max_delay_days"),
        F.sum(F.when(this_quarter, F.col("on_time"))).alias("current_hits"),
        F.count_if(this_quarter).alias("current_lines"),
        F.sum(F.when(prior, F.col("on_time"))).alias("prior_hits"),
        F.count_if(prior).alias("prior_lines"),
    )
    if count_orders:
        sums = _with_distinct(sums, lines, "po_id", "total_pos")
    return sums.select(
        "supplier_id",
        "total_line_items",
        "accurate_invoice_lines",
        *(["total_pos"] if count_orders else []),
        F.col("total_ordered_qty").cast("double"),
        F.col("total_received_qty").cast("double"),
        round_half_up(mean(F.col("gap_ratio_sum"), F.col("gap_ratio_n")) * 100, 2).alias("avg_price_variance_pct"),
        F.col("total_invoice_variance_usd"),
        ratio_of_sums(F.col("total_received_qty"), F.col("total_ordered_qty")).alias("fill_rate_pct"),
        on_time_pct("on_time_lines", "total_line_items").alias("on_time_delivery_pct"),
        round_half_up(mean(F.col("late_days"), F.col("late_lines")), 1).alias("avg_delay_days_when_late"),
        F.col("max_delay_days").cast("bigint"),
        on_time_pct("current_hits", "current_lines").alias("otd_pct_current_qtr"),
        on_time_pct("prior_hits", "prior_lines").alias("otd_pct_prior_qtr"),
    )


def _with_distinct(sums: DataFrame, rows: DataFrame, column: str, name: str) -> DataFrame:
    """``sums`` by supplier with the number of distinct values of ``column``; just the pairs are shuffled, so a large supplier is spread."""
    pairs = rows.where(F.col(column).isNotNull()).select(F.col("supplier_id").alias("_of"), column).distinct()
    counted = pairs.groupBy("_of").agg(F.count("*").alias("_n"))
    joined = sums.join(counted, F.col("supplier_id").eqNullSafe(F.col("_of")), "left")
    return joined.select(*sums.columns, F.coalesce("_n", F.lit(0)).alias(name))


def receipt_quality(receipts: DataFrame, as_of: date, months: int = 12) -> DataFrame:
    """Receipts, rejects, defect rate and distinct receipts with rejects, per supplier.

    Only the notes with a reject are shuffled one by one; a note without number is none.
    """
    recent = receipts.where(F.col("receipt_date") >= day(months_back(as_of, months)))
    sums = recent.groupBy("supplier_id").agg(
        F.count("*").alias("total_receipts"),
        F.sum("rejected_qty").alias("total_rejected_qty"),
        F.sum("accepted_qty").alias("total_accepted_qty"),
        F.sum("received_qty").alias("total_received_qty"),
    )
    sums = _with_distinct(sums, recent.where(F.col("rejected_qty") > 0), "grn_id", "shipments_with_defects")
    return sums.select(
        "supplier_id",
        "total_receipts",
        F.col("total_rejected_qty").cast("double"),
        F.col("total_accepted_qty").cast("double"),
        ratio_of_sums(F.col("total_rejected_qty"), F.col("total_received_qty")).alias("defect_rate_pct"),
        "shipments_with_defects",
    )


def composite_score(on_time: Column, fill: Column, price_gap: Column, defects: Column) -> Column:
    """Weighted score to one decimal; any NULL part makes it NULL."""
    price_part = floor_at_zero(100 - F.abs(price_gap) * 10)
    quality_part = floor_at_zero(100 - defects * 5)
    parts = on_time * WEIGHTS["on_time"] + fill * WEIGHTS["fill"]
    return round_half_up(parts + price_part * WEIGHTS["price"] + quality_part * WEIGHTS["quality"], 1)


def status(score: Column) -> Column:
    """A NULL score has the lowest status."""
    chain = None
    for bound, label in STATUS_BOUNDS:
        chain = F.when(score >= bound, label) if chain is None else chain.when(score >= bound, label)
    return chain.otherwise(LOWEST_STATUS)


def scored_suppliers(
    orders: DataFrame, receipts: DataFrame, suppliers: DataFrame, as_of: date, prior_months: int = 6
) -> DataFrame:
    """Measures and score of every supplier with counted lines and a supplier record."""
    measures = supplier_measures(recent_lines(orders, as_of), as_of, prior_months)
    quality = receipt_quality(receipts, as_of).select("supplier_id", "defect_rate_pct", "shipments_with_defects")
    people = suppliers.select("supplier_id", "supplier_name", "supplier_tier", "country_of_origin")
    return (
        measures.join(people, "supplier_id")
        .join(quality, "supplier_id", "left")
        .withColumns(
            {
                "defect_rate_pct": F.coalesce("defect_rate_pct", F.lit(0.0)),
                "shipments_with_defects": F.coalesce("shipments_with_defects", F.lit(0)).cast("bigint"),
                "otd_qtr_delta": round_half_up(
                    F.col("otd_pct_current_qtr") - F.coalesce("otd_pct_prior_qtr", "otd_pct_current_qtr"), 2
                ),
            }
        )
        .withColumn(
            "composite_score",
            composite_score(
                F.col("on_time_delivery_pct"),
                F.col("fill_rate_pct"),
                F.col("avg_price_variance_pct"),
                F.col("defect_rate_pct"),
            ),
        )
    )


def ranked_suppliers(scored: DataFrame) -> DataFrame:
    """Adds status, rank within tier and quartile; a NULL score sorts first, as the largest value.

    The scores are stored first, so that sampling them for the range bounds does
    not run the aggregates and joins behind them again. Only supplier, tier and score
    are ranked; the other columns are joined back.
    """
    scored = staged(scored, "scores")
    narrow = scored.select("supplier_id", "supplier_tier", "composite_score")
    with_rank = rank_at_scale(narrow, ["supplier_tier"], "composite_score", [F.col("supplier_id")], "rank_within_tier")
    tiled = ntile_at_scale(
        with_rank, 4, [F.col("composite_score").desc_nulls_first(), F.col("supplier_id")], "_tile"
    )
    tiled = scored.join(tiled.select("supplier_id", "rank_within_tier", "_tile"), "supplier_id")
    labels = F.array(*[F.lit(label) for label in QUARTILE_LABELS])
    return tiled.withColumns(
        {
            "supplier_status": status(F.col("composite_score")),
            "performance_quartile": F.element_at(labels, F.col("_tile").cast("int")),
        }
    ).drop("_tile")


def supplier_scorecard(
    orders: DataFrame, receipts: DataFrame, suppliers: DataFrame, as_of: date, prior_months: int = 6
) -> DataFrame:
    """The scorecard, best score first.

    ``prior_months`` is the length of the comparison window before the current
    quarter: six months, that is two quarters.
    """
    rows = ranked_suppliers(scored_suppliers(orders, receipts, suppliers, as_of, prior_months))
    return rows.select(
        "supplier_id",
        "supplier_name",
        "supplier_tier",
        "country_of_origin",
        "total_pos",
        "fill_rate_pct",
        "on_time_delivery_pct",
        "avg_delay_days_when_late",
        "defect_rate_pct",
        "avg_price_variance_pct",
        F.round("total_invoice_variance_usd", 2).cast("decimal(38,2)").alias("invoice_variance_usd"),
        "otd_pct_current_qtr",
        "otd_pct_prior_qtr",
        "otd_qtr_delta",
        "composite_score",
        "supplier_status",
        F.col("rank_within_tier").cast("bigint").alias("rank_within_tier"),
        "performance_quartile",
    ).orderBy(F.col("composite_score").desc_nulls_first(), "supplier_id")
