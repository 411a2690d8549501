"""Daily summary fed by a stream of movements or of their changes."""

from __future__ import annotations

import json
import posixpath

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from opsflow.plans.summary import COUNTED_TYPES, KEYS, fold
from opsflow.schemas import SUMMARY_FEED
from opsflow.sources.tables import read_or_empty


def run_summary_stream(
    rows: DataFrame, path: str, checkpoint: str, sequence: str | None = None, every: str | None = None, grain: str = "month"
) -> StreamingQuery:
    """Folds each micro-batch into the stored summary.

    A stream with an action column is a change feed: what it deletes is taken off again, and
    an update takes off the old row and adds the new one. No state is held between
    batches, and a late row is never dropped. ``sequence`` names a column of numbers that
    ascend over the source, which makes the summary independent of the checkpoint. Without
    one, the batch numbers stand for it, and the summary refuses any checkpoint but its first.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        if sequence is None:
            require_same_feed(batch.sparkSession, path, checkpoint)
        fold(path, batch, F.col(sequence) if sequence else F.lit(batch_id), grain)

    writer = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def require_same_feed(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Notes which checkpoint feeds ``path`` and fails if another one did before: its batch numbers mean other rows."""
    own = json.loads(spark.read.text(posixpath.join(checkpoint, "metadata")).first()[0])["id"]
    known = read_or_empty(spark, f"{path}-feed", SUMMARY_FEED).first()
    if known is None:
        spark.createDataFrame([(own,)], SUMMARY_FEED).write.parquet(f"{path}-feed")
    elif known.feed != own:
        raise ValueError(f"{path} is fed under another checkpoint")


def windowed_summary(movements: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Event-time form: one-day windows with state bounded by ``lateness``.

    Rows later than that are not counted, so use :func:`run_summary_stream` where they
    must be. Watermarks need a timestamp with zone and windows start at midnight UTC, so
    the zoneless date is read as UTC and the window start read back, whatever the
    session's zone.
    """
    kind, zone = F.col("transaction_type"), F.current_timezone()
    stamped = movements.where(kind.isin(*COUNTED_TYPES)).withColumn(
        "event_ts", F.from_utc_timestamp(F.col("transaction_date").cast("timestamp"), zone)
    )
    received = F.sum(F.when(kind == "RECEIPT", F.col("quantity")).otherwise(F.lit(0)))
    shipped = F.sum(F.when(kind == "SHIPMENT", F.col("quantity")).otherwise(F.lit(0)))
    sums = stamped.withWatermark("event_ts", lateness).groupBy(
        F.window("event_ts", "1 day"), "warehouse_id", "sku_id", "category"
    ).agg(received.alias("total_received"), shipped.alias("total_shipped"), F.avg("unit_cost").alias("avg_unit_cost"))
    return sums.select(
        F.to_date(F.to_utc_timestamp("window.start", zone)).alias("snapshot_day"),
        *KEYS[1:],
        "total_received",
        "total_shipped",
        (F.col("total_received") - F.col("total_shipped")).alias("net_movement"),
        "avg_unit_cost",
    )


def run_windowed_stream(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes each micro-batch's changed windows to its own folder, the days still open included.

    The folders are told apart by batch numbers, so ``path`` refuses a second checkpoint.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        require_same_feed(batch.sparkSession, path, checkpoint)
        batch.write.mode("overwrite").parquet(posixpath.join(path, f"batch_id={batch_id}"))

    writer = windows.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_windowed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest state of every window."""
    rows = spark.read.schema(schema.add("batch_id", "long")).parquet(path)
    values = [c for c in schema.names if c not in (*KEYS, "batch_id")]
    newest = rows.groupBy(*KEYS).agg(F.max(F.struct("batch_id", *values)).alias("newest"))
    return newest.select(*KEYS, *[F.col(f"newest.{c}").alias(c) for c in values])
