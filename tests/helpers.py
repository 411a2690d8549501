"""Small literal tables and plan text."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

D = Decimal


def day(text: str) -> date:
    return date.fromisoformat(text)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def by_key(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) != 1 else r[columns[0]] for r in df.collect()}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
