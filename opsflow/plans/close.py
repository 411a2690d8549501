"""Monthly close: aggregate a month, stage it, upsert it into the close table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsflow.context import period_label
from opsflow.functions.dates import in_month
from opsflow.operators.changes import upsert
from opsflow.schemas import MONTHLY_CLOSE, conform
from opsflow.session import job_scope, staged
from opsflow.sources.tables import drop_path, read_or_empty, replace_partitions

KEYS = ("sku_id", "warehouse_id", "close_period")
VALUES = ("net_qty", "total_value")


def close_rows(movements: DataFrame, year: int, month: int) -> DataFrame:
    """Net quantity and value per SKU and warehouse of one month.

    The month is a range on the bare date column, so the scan skips other months.
    """
    return (
        movements.where(in_month(F.col("transaction_date"), year, month))
        .groupBy("sku_id", "warehouse_id")
        .agg(
            F.sum("quantity").cast("decimal(38,4)").alias("net_qty"),
            F.sum(F.col("quantity") * F.col("unit_cost")).cast("decimal(38,4)").alias("total_value"),
        )
        .withColumn("close_period", F.lit(period_label(year, month)))
    )


def upsert_close(table: DataFrame, rows: DataFrame, run_ts: datetime) -> DataFrame:
    """Close table with the month's rows updated or added; other rows keep their stamp."""
    return upsert(table, rows, KEYS, VALUES, run_ts)


def monthly_close(
    spark: SparkSession,
    movements: DataFrame,
    year: int,
    month: int,
    staging_path: str,
    close_path: str,
    run_ts: datetime,
) -> str:
    """Runs the close for one month; a second run gives the same table.

    Staging and close table are partitioned by period and only this period's
    partition is read and rewritten. Staging is cleared first, so a month without
    movements does not close on the rows of an earlier run.
    """
    period = period_label(year, month)
    drop_path(spark, f"{staging_path}/close_period={period}")
    replace_partitions(conform(close_rows(movements, year, month), MONTHLY_CLOSE), staging_path, ["close_period"])
    this_period = F.col("close_period") == period
    source = read_or_empty(spark, staging_path, MONTHLY_CLOSE).where(this_period)
    current = read_or_empty(spark, close_path, MONTHLY_CLOSE).where(this_period)
    with job_scope(spark):
        # Stored first, because the partition that it replaces is also read for it.
        closed = staged(upsert_close(current, source, run_ts), "monthly-close")
        replace_partitions(closed, close_path, ["close_period"])
    return f"Monthly close for {period} completed successfully."
