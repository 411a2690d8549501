"""Clustered and bucketed writes, and the key ranges of the files they leave."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    partition_by: Sequence[str] = (),
    spread_by: Sequence[str] = (),
    mode: str = "append",
) -> None:
    """Writes files that each cover a narrow range of ``cluster_by``.

    ``spread_by`` columns extend the range key, so that one value holding a
    large share of the rows (a busy warehouse, say) is cut over several files.
    """
    keys = [*partition_by, *[c for c in cluster_by if c not in partition_by]]
    full = [*keys, *[c for c in spread_by if c not in keys]]
    placed = df.repartitionByRange(*full).sortWithinPartitions(*full)
    writer = placed.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_rebalanced(
    df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str], measure: Callable | None = None
) -> None:
    """Appends in one pass: rows gathered by ``partition_by`` and ``cluster_by``, sorted inside each file.

    Unlike the range form this needs no sampling pass over the input, so a load
    computes its rows once. AQE merges small groups and cuts a large one over
    several tasks. ``measure`` may wrap the frame that is written, behind the
    last shuffle, where a repeated task is not counted twice.
    """
    gathered = df.hint("rebalance", *[F.col(c) for c in [*partition_by, *cluster_by]])
    placed = gathered.sortWithinPartitions(*partition_by, *cluster_by)
    if measure is not None:
        placed = measure(placed)
    placed.write.mode("append").partitionBy(*partition_by).parquet(path)


def buckets_for(*tables: DataFrame, bucket_rows: int = 1 << 20, least: int = 8) -> int:
    """A power of two of buckets, alike for tables that are to be joined, that gives about ``bucket_rows`` rows to one or fewer."""
    wanted = max(least, -(-sum(t.count() for t in tables) // bucket_rows))
    return 1 << (wanted - 1).bit_length()


def write_bucketed(
    df: DataFrame, table: str, buckets: int, keys: Sequence[str], mode: str = "overwrite", path: str | None = None
) -> None:
    """Catalog table bucketed and sorted by ``keys``, so that joins and groups on them need no shuffle.

    Rows are dealt to one task a bucket first, so that a bucket is one sorted file and not
    one of every task. ``path`` names the folder of an external table.
    """
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    writer = dealt.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def join_bucketed(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join of two tables bucketed alike on ``keys``: bucket meets bucket where they lie, and nothing is shuffled.

    Meant for two large sides; the hint keeps Spark from sending round the one that looks small.
    """
    return left.hint("merge").join(right.hint("merge"), list(keys), how)


def file_ranges(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per data file: row count and the smallest and largest key."""
    return (
        df.withColumn("file", F.input_file_name())
        .groupBy("file")
        .agg(
            F.count("*").alias("row_count"),
            F.min(F.struct(*key)).alias("low"),
            F.max(F.struct(*key)).alias("high"),
        )
    )


def files_in_order(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: the number of files, and whether each one begins where the one before it has ended, or later.

    One row a file stands in the window, whatever the number of rows.
    """
    before = F.lag("high").over(Window.orderBy("low", "high"))
    begun = file_ranges(df, key).withColumn("apart", F.coalesce(before <= F.col("low"), F.lit(True)))
    return begun.agg(F.count("*").alias("file_count"), F.coalesce(F.bool_and("apart"), F.lit(True)).alias("in_order"))
