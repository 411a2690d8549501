"""Distinct counts as stored sketches that merge over any window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Bits of the number of registers: 4,096, for a relative standard error of 1.04 / 64, that is 1.6 %.
REGISTER_BITS = 12
STANDARD_ERROR = 1.04 / 2 ** (REGISTER_BITS / 2)


def distinct_sketches(rows: DataFrame, keys: Sequence[str], column: str, bits: int = REGISTER_BITS) -> DataFrame:
    """One HyperLogLog sketch of ``column`` per group, as bytes to store.

    A sketch takes a few kilobytes at most, whatever the number of values, and is built inside the input
    tasks, so a hot group shuffles one sketch a task. NULL values are not counted.
    """
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(F.col(column).cast("string"), F.lit(bits)).alias("sketch"))


def merged_counts(sketches: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Estimated distinct values per group of ``keys`` over all the sketches given, as a long."""
    merged = sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("_sketch"))
    return merged.select(*keys, F.hll_sketch_estimate("_sketch").alias(name))


def within(estimate: str, exact: str, errors: float = 4.0):
    """Whether an estimate lies within so many standard errors of the exact count."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.lit(errors * STANDARD_ERROR) * F.col(exact)
