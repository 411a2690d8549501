"""Change micro-batches merged into a fact table.

The table is plain Parquet partitioned by a hash of the key. A batch reads the partitions
its changes fall in, merges, stores the outcome beside the table, and then swaps those
partitions in by dynamic partition overwrite; every other partition is left alone. Keys are
unique, so no partition is hot; choose ``buckets`` so that one holds a few hundred
megabytes, and so many that a usual batch does not touch them all.

A repeated batch gives the same table, since each merge step can be taken twice: what is
gone stays gone, and a row that was inserted or updated is so again. With a ``sequence``
column, whose numbers ascend over the whole source, a mark beside the table also tells
which changes are in it, whatever checkpoint or batch number they come under: a stream
that starts again with a fresh checkpoint passes over what it has delivered before. Without
one, a source must not be read again from its start once later batches were merged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from opsflow.functions.dates import naive
from opsflow.operators import changes as chg
from opsflow.schemas import MERGE_MARKS
from opsflow.session import job_scope, staged
from opsflow.sources.tables import drop_path, read_or_empty, replace_partitions

BUCKET = "bucket"


@dataclass(frozen=True)
class FactTable:
    """Where the fact lies and how it is merged; ``sequence`` orders the changes of a key and marks what was merged."""

    path: str
    schema: StructType
    key: str
    update_columns: Sequence[str]
    stamp_column: str = "last_updated_ts"
    buckets: int = 256
    sequence: str | None = None

    @property
    def marks_path(self) -> str:
        return f"{self.path}-marks"

    def bucket_of(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def stored(self, spark: SparkSession) -> DataFrame:
        """The rows with their partition, which filters can name."""
        return read_or_empty(spark, self.path, StructType([*self.schema, StructField(BUCKET, IntegerType())]))

    def read(self, spark: SparkSession) -> DataFrame:
        return self.stored(spark).select(*self.schema.names)

    def mark(self, spark: SparkSession) -> int | None:
        """The highest sequence number merged so far."""
        return read_or_empty(spark, self.marks_path, MERGE_MARKS).agg(F.max("mark")).first()[0]


def merge_batch(feed: DataFrame, table: FactTable, run_ts: datetime) -> None:
    """Merges one batch of changes; those up to the table's mark are in it already and are passed over."""
    spark = feed.sparkSession
    columns = [f for f in table.schema if f.name != table.stamp_column]
    extra = [chg.ACTION, chg.IS_UPDATE, *([table.sequence] if table.sequence else [])]
    fresh = feed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns], *extra)
    if table.sequence:
        mark = table.mark(spark)
        fresh = fresh if mark is None else fresh.where(F.col(table.sequence) > F.lit(mark))
    # At most ``buckets`` small numbers; as literals they prune the partitions before the scan starts.
    touched = sorted(r[0] for r in fresh.select(table.bucket_of(table.key)).distinct().collect())
    if not touched:
        return
    current = table.stored(spark).where(F.col(BUCKET).isin(touched)).select(*table.schema.names)
    merged = chg.merge_changes(current, fresh, table.key, table.update_columns, run_ts, table.stamp_column, table.sequence)
    with job_scope(spark):
        beside = staged(merged.withColumn(BUCKET, table.bucket_of(table.key)), "merged")
        replace_partitions(beside, table.path, [BUCKET])
        # The overwrite leaves a partition alone that has no rows any more.
        held = {r[0] for r in beside.select(BUCKET).distinct().collect()}
        for bucket in touched:
            if bucket not in held:
                drop_path(spark, f"{table.path}/{BUCKET}={bucket}")
    if table.sequence:
        # Last, so that a batch that failed before is taken again whole.
        reached = fresh.agg(F.max(table.sequence).cast("bigint").alias("mark")).withColumn("merged_at", naive(run_ts))
        reached.write.mode("append").parquet(table.marks_path)


def run_cdc_stream(
    source: DataFrame,
    table: FactTable,
    checkpoint: str,
    run_ts: datetime,
    every: str | None = None,
) -> StreamingQuery:
    """Merges a stream of change rows; ``every`` (say ``15 minutes``) keeps it running, None drains and stops.

    An empty micro-batch does nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        # Searched for partitions, then merged; keep it instead of reading the source again.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            merge_batch(batch, table, run_ts)
        finally:
            batch.unpersist()

    writer = source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
