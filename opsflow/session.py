"""Session settings and the shared working folder."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# AQE sizes the reduce side at run time, picks broadcast joins from measured
# sizes, and splits skewed join partitions, so no join in this library carries a
# broadcast hint for a table whose size is not bounded by construction.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def scale_settings(shuffle_bytes: int, cores: int, task_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a run whose largest shuffle moves ``shuffle_bytes``.

    The reduce side starts with pieces of about ``task_bytes``, which fit in memory
    next to their sort buffers, and AQE merges the ones that turn out small. Too
    few pieces cannot be mended at run time, except in joins and rebalanced writes.
    """
    pieces = max(cores, -(-shuffle_bytes // task_bytes))
    return {
        "spark.sql.shuffle.partitions": str(pieces),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * task_bytes),
    }


def build_session(app_name: str = "opsflow", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir`` or set on the context."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder


_SCOPE: ContextVar[str] = ContextVar("opsflow_scope", default="")


def work_dir(spark: SparkSession) -> str:
    """This application's folder below the shared one, or the folder of the job scope that is open."""
    return posixpath.join(shared_dir(spark), "opsflow", spark.sparkContext.applicationId, _SCOPE.get()).rstrip("/")


@contextmanager
def job_scope(spark: SparkSession) -> Iterator[str]:
    """Everything stored inside the scope goes to a folder of its own, which is removed at the end.

    A job reads its result, or writes it to its place, before the scope ends.
    """
    token = _SCOPE.set(posixpath.join(_SCOPE.get(), f"job-{uuid.uuid4().hex}"))
    folder = work_dir(spark)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in this application's folder."""
    return posixpath.join(work_dir(spark), f"{label}-{uuid.uuid4().hex}")


def staged(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written once below the shared folder and read back.

    Used where one result feeds several branches, or where row placement must be
    fixed: the table cuts the lineage, survives lost executors, and each branch
    reads only the columns it needs.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
