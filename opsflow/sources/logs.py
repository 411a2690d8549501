"""Append-only control tables: pipeline runs and report deliveries."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsflow.schemas import DELIVERY_LOG, RUN_LOG
from opsflow.sources.tables import read_or_empty

SUCCESS, FAILURE, NO_DATA = "SUCCESS", "FAILURE", "NO_DATA"


def append_run(
    spark: SparkSession,
    path: str,
    pipeline: str,
    run_ts: datetime,
    rows: int,
    status: str = SUCCESS,
    error: str | None = None,
) -> None:
    """One row per run. ``run_ts`` is taken before the extract and is the next run's starting point."""
    entry = spark.createDataFrame([(pipeline, run_ts, rows, status, error)], RUN_LOG)
    entry.coalesce(1).write.mode("append").parquet(path)


def last_success(spark: SparkSession, path: str, pipeline: str) -> datetime | None:
    """Newest successful run of the pipeline; None without a log or such a run. A log that cannot be read fails."""
    log = read_or_empty(spark, path, RUN_LOG)
    done = log.where((F.col("pipeline_name") == pipeline) & (F.col("status") == SUCCESS))
    return done.agg(F.max("load_timestamp")).first()[0]


def append_delivery(
    spark: SparkSession,
    path: str,
    report: str,
    run_ts: datetime,
    status: str,
    rows: int,
    recipients: Sequence[str],
    error: str | None = None,
) -> None:
    entry = spark.createDataFrame([(run_ts, report, status, rows, "; ".join(recipients), error)], DELIVERY_LOG)
    entry.coalesce(1).write.mode("append").parquet(path)


def delivery_manifest(log: DataFrame) -> DataFrame:
    """One row per delivery and recipient."""
    return log.select(
        "logged_at", "report_name", "status", "row_count", F.explode(F.split("recipients", "; ")).alias("recipient")
    )
