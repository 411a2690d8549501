"""Incremental load driven by new files instead of a stored watermark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from opsflow.plans.etl import Sources, cleansed


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = None, name_glob: str | None = None
) -> DataFrame:
    """Stream of the Parquet files that appear in ``folder``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.parquet(folder)


def run_load_stream(
    sources: Sources,
    target_path: str,
    checkpoint: str,
    run_ts: datetime,
    earliest: datetime,
    every: str | None = None,
) -> StreamingQuery:
    """Cleanses a stream of movements into the staging table; the file sink writes each batch exactly once."""
    rows = cleansed(sources, earliest, run_ts)
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy("TRANSACTION_YEAR", "TRANSACTION_MONTH")
        .option("path", target_path)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
