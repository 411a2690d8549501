"""Date parsing, ages and period filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, functions as F

from opsflow.context import month_bounds

# Text formats tried in turn; each value is parsed on its own.
TEXT_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
    "yyyyMMdd",
)


def parse_timestamp(column: Column, is_text: bool = True, formats: Sequence[str] = TEXT_FORMATS) -> Column:
    """Timestamp without zone; text in none of ``formats`` gives NULL, never an error."""
    if not is_text:
        return column.cast("timestamp_ntz")
    general = column.try_cast("timestamp_ntz")
    listed = [F.try_to_timestamp(column, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(general, *listed)


def age_hours(latest: Column, run_ts: datetime) -> Column:
    """Hours from ``latest`` (without zone) to ``run_ts``, with the fraction."""
    return F.timestamp_diff("MICROSECOND", latest, naive(run_ts)) / F.lit(3_600_000_000)


def in_month(column: Column, year: int, month: int) -> Column:
    """Half-open month range on the bare column, so that it reaches the file scan."""
    first, after = month_bounds(year, month)
    return (column >= naive(first)) & (column < naive(after))


def naive(moment: datetime) -> Column:
    """Literal timestamp without zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def day(value: date) -> Column:
    """Literal date."""
    return F.lit(value.isoformat()).cast("date")
