"""Row-based rolling statistics and lags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from opsflow.functions.numeric import mean


def rolling_stats(
    daily: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    rows: int = 7,
    exclude_current: bool = False,
) -> DataFrame:
    """Adds ``rolling_avg``, ``rolling_stddev``, ``prior_day`` and ``prior_week``.

    Frames and lags count rows, not days: a missing day moves them. ``daily``
    holds one row per key and day, so no window group outgrows the lookback.
    """
    along = Window.partitionBy(*keys).orderBy(order)
    frame = along.rowsBetween(-rows, -1) if exclude_current else along.rowsBetween(1 - rows, 0)
    column = F.col(value)
    return daily.withColumns(
        {
            "rolling_avg": mean(F.sum(column).over(frame), F.count(column).over(frame)),
            "rolling_stddev": F.stddev_samp(column.cast("double")).over(frame),
            "prior_day": F.lag(column, 1).over(along),
            "prior_week": F.lag(column, rows).over(along),
        }
    )


def fill_missing_days(daily: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """One row per key and calendar day between the key's first and last day; new days carry NULL."""
    span = daily.groupBy(*keys).agg(F.min(order).alias("_from"), F.max(order).alias("_to"))
    days = span.select(*keys, F.explode(F.sequence("_from", "_to")).alias(order))
    return days.join(daily.select(*keys, order, value), [*keys, order], "left")
