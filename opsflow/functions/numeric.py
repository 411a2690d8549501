"""Rounding and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Quotients are read at six decimals before the half-up rounding, so that the
# last bits of a binary double never decide a tie.
RATIO_TYPE = "decimal(30,6)"


def round_half_up(value: Column, places: int) -> Column:
    """A double rounded half away from zero, as a double (-0.0 becomes 0.0)."""
    return F.round(value.cast(RATIO_TYPE), places).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; NULL for a zero or NULL denominator."""
    bottom = denominator.cast("double")
    return F.when(bottom != 0, numerator.cast("double") / bottom)


def ratio_of_sums(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """``numerator * 100 / denominator`` over exact sums, rounded; NULL on a zero sum."""
    return round_half_up(ratio(numerator * F.lit(100), denominator), places)


def mean(total: Column, count: Column) -> Column:
    """Average from an exact sum and a count; NULL when nothing was counted."""
    return ratio(total, count)


def pct_change(current: Column, prior: Column, places: int = 2) -> Column:
    """Change of ``current`` against ``prior`` in percent; NULL if ``prior`` is 0 or NULL."""
    return round_half_up(ratio((current - prior) * F.lit(100), prior), places)


def round_half_even(value: Column, places: int, result_type: str) -> Column:
    """Banker's rounding of an exact decimal."""
    return F.bround(value, places).cast(result_type)


def floor_at_zero(value: Column) -> Column:
    """The larger of 0 and ``value``; NULL stays NULL, unlike ``greatest``."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def lenient_double(column: Column) -> Column:
    """Numeric reading of any column; text that is no number gives NULL."""
    return column.cast("string").try_cast("double")
