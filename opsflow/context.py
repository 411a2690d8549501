"""Run dates. No job reads the clock: the caller passes these in."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta


@dataclass(frozen=True)
class RunContext:
    """``as_of`` stands for the current date and ``run_ts`` for the current timestamp."""

    as_of: date
    run_ts: datetime

    @classmethod
    def at(cls, run_ts: datetime) -> "RunContext":
        return cls(run_ts.date(), run_ts)


def months_back(day: date, months: int) -> date:
    """``day`` moved back by whole months, held to the last day of a shorter month."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    last = (date(year + (month + 1) // 12, (month + 1) % 12 + 1, 1) - timedelta(days=1)).day
    return date(year, month + 1, min(day.day, last))


def quarter_start(day: date) -> date:
    return date(day.year, (day.month - 1) // 3 * 3 + 1, 1)


def period_label(year: int, month: int) -> str:
    return f"{year:04d}-{month:02d}"


def month_bounds(year: int, month: int) -> tuple[datetime, datetime]:
    """First instant of the month and of the month after, for a half-open filter."""
    following = date(year + month // 12, month % 12 + 1, 1)
    return datetime(year, month, 1), datetime(following.year, following.month, 1)


def resolve_date_token(value: str, as_of: date) -> str:
    """``today`` and ``last_sunday`` (a Sunday gives itself) as ISO text; anything else unchanged."""
    if value == "today":
        return as_of.isoformat()
    if value == "last_sunday":
        return (as_of - timedelta(days=as_of.isoweekday() % 7)).isoformat()
    return value
