"""Change feed of a commit log, consumed from a stored offset.

The log holds every committed row version, numbered by commit. A consumer has seen the log
up to its offset; what it gets next are the net changes of the keys committed after that.
The offset moves only when the consumer's work is done, so a run that fails gets the same
changes again, together with those committed since.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opsflow.functions.dates import naive
from opsflow.operators.changes import ACTION, IS_UPDATE
from opsflow.operators.versions import ACTION as LOG_ACTION, COMMIT_ID, COMMIT_TS
from opsflow.schemas import FEED_OFFSETS
from opsflow.sources.tables import read_or_empty

NOTHING_SEEN = -1


def feed_between(log: DataFrame, keys: Sequence[str], after: int, upto: int, append_only: bool = False) -> DataFrame:
    """Net changes of the commits numbered ``after`` + 1 to ``upto``, in the form of ``changes.changes``.

    Only that slice of the log is read whole. Of the log before it, the semi join keeps
    the rows of the slice's keys, and both sides meet in one aggregate: the last version
    up to ``after`` and the last one of the slice, as ``max`` over (number, row), which
    combines inside the input tasks however long a key's history is. A key deleted and
    inserted again within the slice, or changed back, has no other trace than its outcome.
    ``append_only`` keeps the rows of keys that did not exist before.
    """
    number = F.col(COMMIT_ID)
    body = [c for c in log.columns if c not in (*keys, COMMIT_TS, COMMIT_ID, LOG_ACTION)]
    version = F.struct(COMMIT_ID, LOG_ACTION, *body)
    fresh = log.where((number > F.lit(after)) & (number <= F.lit(upto)))
    touched = fresh.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    same = _all([F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    older = log.where(number <= F.lit(after)).join(touched, same, "left_semi")
    both = fresh.select(*keys, version.alias("_new"), F.lit(None).cast(older.select(version.alias("v")).schema["v"].dataType).alias("_old"))
    both = both.unionByName(older.select(*keys, F.lit(None).cast(both.schema["_new"].dataType).alias("_new"), version.alias("_old")))
    states = both.groupBy(*keys).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    was = F.coalesce(F.col(f"_old.{LOG_ACTION}") != "DELETE", F.lit(False))
    is_now = F.col(f"_new.{LOG_ACTION}") != "DELETE"
    if append_only:
        born = states.where(is_now & ~was)
        return born.select(*_row(keys, body, "_new"), F.lit("INSERT").alias(ACTION), F.lit(False).alias(IS_UPDATE))
    alike = _all([F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in body])
    images = F.array_compact(F.array(
        F.when(was, F.struct(F.col("_old").alias("row"), F.lit("DELETE").alias(ACTION))),
        F.when(is_now, F.struct(F.col("_new").alias("row"), F.lit("INSERT").alias(ACTION))),
    ))
    changed = states.where((was | is_now) & ~(was & is_now & alike))
    return changed.select(*keys, (was & is_now).alias(IS_UPDATE), F.explode(images).alias("_image")).select(
        *_row(keys, body, "_image.row"), f"_image.{ACTION}", IS_UPDATE
    )


def _all(conditions: Sequence[Column]) -> Column:
    found = F.lit(True)
    for condition in conditions:
        found = found & condition
    return found


def _row(keys: Sequence[str], body: Sequence[str], struct: str) -> list[Column]:
    return [F.col(k) for k in keys] + [F.col(f"{struct}.{c}").alias(c) for c in body]


def offset_of(spark: SparkSession, offsets: str, consumer: str) -> int:
    """Number of the last commit the consumer is done with, or ``NOTHING_SEEN``."""
    mine = read_or_empty(spark, offsets, FEED_OFFSETS).where(F.col("consumer") == consumer)
    return mine.agg(F.coalesce(F.max("commit_id"), F.lit(NOTHING_SEEN))).first()[0]


def newest_commit(log: DataFrame) -> int:
    return log.agg(F.coalesce(F.max(COMMIT_ID), F.lit(NOTHING_SEEN))).first()[0]


def consume(
    log: DataFrame,
    keys: Sequence[str],
    offsets: str,
    consumer: str,
    action: Callable[[DataFrame, int], None],
    run_ts: datetime,
    append_only: bool = False,
) -> int | None:
    """Hands the consumer everything committed since its offset, then moves the offset.

    ``action`` gets the feed and the number of its last commit, by which it can tell a
    repeated delivery. If it fails, the error is raised and the offset stays. Returns the
    new offset, or None if nothing was committed since; then ``action`` does not run.
    """
    spark = log.sparkSession
    seen, newest = offset_of(spark, offsets, consumer), newest_commit(log)
    if newest <= seen:
        return None
    action(feed_between(log, keys, seen, newest, append_only), newest)
    moved = spark.range(1).select(F.lit(consumer).alias("consumer"), F.lit(newest).cast("bigint").alias("commit_id"), naive(run_ts).alias("moved_at"))
    moved.write.mode("append").parquet(offsets)
    return newest
