"""Inventory anomaly report: daily roll-up, rolling statistics, severity, ranks."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.functions.dates import day
from opsflow.functions.numeric import pct_change, round_half_up
from opsflow.operators.aggregates import with_group_total
from opsflow.operators.joins import lookup
from opsflow.operators.ranking import row_number_at_scale
from opsflow.operators.rolling import rolling_stats
from opsflow.session import staged

SERIES = ("sku_id", "warehouse_id")

# Thresholds and labels of the report.
Z_CRITICAL, Z_HIGH, Z_MEDIUM = 3.0, 2.0, 1.5
SEVERITY_ORDER = ("CRITICAL", "HIGH", "MEDIUM")
REASONS = {
    "extreme": "Extreme statistical deviation (Z > 3)",
    "deviation": "Significant deviation from 7-day average",
    "safety": "Below safety stock threshold",
    "reorder": "Below reorder point — replenishment needed",
    "drop": "Sudden inventory drop (>50% day-over-day)",
    "spike": "Unusual inventory spike (>100% day-over-day)",
    "normal": "Within normal range",
}


def daily_inventory(
    transactions: DataFrame, as_of: date | None = None, lookback_days: int | None = 90
) -> DataFrame:
    """Quantities per SKU, warehouse and day, from the last ``lookback_days`` before ``as_of``."""
    if as_of is not None and lookback_days is not None:
        transactions = transactions.where(F.col("transaction_date") >= day(as_of - timedelta(days=lookback_days)))
    return transactions.groupBy(*SERIES, "transaction_date").agg(
        F.sum("quantity_on_hand").alias("daily_qty"),
        F.sum("quantity_received").alias("daily_received"),
        F.sum("quantity_shipped").alias("daily_shipped"),
    )


def scored(daily: DataFrame, exclude_current: bool = False) -> DataFrame:
    """Adds the rolling statistics, the z-score and the changes against one day and seven rows back."""
    spread = F.col("rolling_stddev")
    z = round_half_up((F.col("daily_qty").cast("double") - F.col("rolling_avg")) / spread, 2)
    return rolling_stats(daily, SERIES, "transaction_date", "daily_qty", exclude_current=exclude_current).withColumns(
        {
            "z_score": F.when(spread.isNull() | (spread == 0), F.lit(0.0)).otherwise(z),
            "dod_pct_change": pct_change(F.col("daily_qty"), F.col("prior_day")),
            "wow_pct_change": pct_change(F.col("daily_qty"), F.col("prior_week")),
        }
    )


def severity(z: Column, dod: Column, qty: Column, safety: Column, reorder: Column) -> Column:
    size = F.abs(z)
    return (
        F.when(size >= Z_CRITICAL, "CRITICAL")
        .when(size >= Z_HIGH, "HIGH")
        .when(size >= Z_MEDIUM, "MEDIUM")
        .when((F.abs(dod) >= 50) | (qty < safety), "HIGH")
        .when(qty < reorder, "MEDIUM")
        .otherwise("NORMAL")
    )


def reason(z: Column, dod: Column, qty: Column, safety: Column, reorder: Column) -> Column:
    """Checked in an order of its own, so a flagged row can read as normal."""
    size = F.abs(z)
    return (
        F.when(size >= Z_CRITICAL, REASONS["extreme"])
        .when(size >= Z_HIGH, REASONS["deviation"])
        .when(qty < safety, REASONS["safety"])
        .when(qty < reorder, REASONS["reorder"])
        .when(dod <= -50, REASONS["drop"])
        .when(dod >= 100, REASONS["spike"])
        .otherwise(REASONS["normal"])
    )


def flagged(scored_days: DataFrame, skus: DataFrame) -> DataFrame:
    """Anomalous rows with their SKU data and estimated exposure; SKUs without master data drop out."""
    known = lookup(
        scored_days,
        skus.select("sku_id", "sku_name", "category", "unit_cost", "reorder_point", "safety_stock"),
        {"sku_id": "sku_id"},
    )
    facts = [F.col(c) for c in ("z_score", "dod_pct_change", "daily_qty", "safety_stock", "reorder_point")]
    gap = F.abs(F.col("daily_qty").cast("double") - F.col("rolling_avg"))
    exposure = round_half_up(gap * F.col("unit_cost").cast("double"), 2)
    return known.withColumns(
        {
            "anomaly_severity": severity(*facts),
            "anomaly_reason": reason(*facts),
            "estimated_variance_usd": exposure,
        }
    ).where(F.col("anomaly_severity") != "NORMAL")


def ranked(anomalies: DataFrame) -> DataFrame:
    """Adds the rank within category and day and the warehouse's total of the day.

    Neither a category nor a warehouse is bounded in size, so the rank comes from
    range pieces and the total from an aggregate joined back. The anomalies are
    stored first: the range bounds are sampled and the totals summed from them,
    without running the rolling windows again.
    """
    anomalies = staged(anomalies, "anomalies")
    by_exposure = [F.col("estimated_variance_usd").desc_nulls_first(), F.col("sku_id"), F.col("warehouse_id")]
    numbered = row_number_at_scale(anomalies, ["category", "transaction_date"], by_exposure, "rank_in_category")
    cents = F.col("estimated_variance_usd").cast("decimal(30,2)")
    totalled = with_group_total(
        numbered, ["warehouse_id", "transaction_date"], cents, "warehouse_total_variance_usd", rows=anomalies
    )
    return totalled.withColumn("warehouse_total_variance_usd", F.col("warehouse_total_variance_usd").cast("double"))


def report_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "transaction_date",
        "sku_id",
        "sku_name",
        "category",
        "warehouse_id",
        "anomaly_severity",
        "anomaly_reason",
        F.col("daily_qty").cast("double").alias("current_qty"),
        round_half_up(F.col("rolling_avg"), 0).alias("avg_7d_qty"),
        "reorder_point",
        "safety_stock",
        "z_score",
        F.col("dod_pct_change").alias("day_over_day_pct"),
        F.col("wow_pct_change").alias("week_over_week_pct"),
        "estimated_variance_usd",
        "rank_in_category",
        "warehouse_total_variance_usd",
    )


def anomalies_all_days(
    transactions: DataFrame,
    skus: DataFrame,
    as_of: date | None = None,
    lookback_days: int | None = 90,
    exclude_current: bool = False,
) -> DataFrame:
    """Every anomaly of the lookback, ranked within its own day."""
    daily = daily_inventory(transactions, as_of, lookback_days)
    return report_columns(ranked(flagged(scored(daily, exclude_current), skus)))


def inventory_anomaly_report(
    transactions: DataFrame,
    skus: DataFrame,
    as_of: date,
    lookback_days: int = 90,
    exclude_current: bool = False,
) -> DataFrame:
    """Anomalies of the report day, most severe and costliest first.

    Ranks and totals are per day, so the day's filter is applied before them; the
    rolling statistics still see the whole lookback.
    """
    days = scored(daily_inventory(transactions, as_of, lookback_days), exclude_current)
    today = flagged(days.where(F.col("transaction_date") == day(as_of)), skus)
    place = F.array_position(F.array(*[F.lit(s) for s in SEVERITY_ORDER]), F.col("anomaly_severity"))
    return report_columns(ranked(today)).orderBy(
        place, F.col("estimated_variance_usd").desc_nulls_first(), "sku_id", "warehouse_id"
    )

