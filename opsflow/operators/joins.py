"""Joins written so that skewed keys can be split at run time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer equi-join; columns come back as ``l_*`` and ``r_*``.

    Written as a left join plus the right rows without a partner. A full outer
    sort-merge join cannot be split when one key (or the NULL key, which never
    matches) holds a large share of the rows; both halves here can, because AQE
    may cut the preserved side of either. Several rows per key multiply as in
    any outer join. Both inputs are read twice, so they should be stored tables
    rather than long plans.
    """
    l = left.select([F.col(c).alias(f"l_{c}") for c in left.columns])
    r = right.select([F.col(c).alias(f"r_{c}") for c in right.columns])
    on = _and([F.col(f"l_{k}") == F.col(f"r_{k}") for k in keys])
    kept = l.join(r, on, "left")
    unmatched = r.join(l.select([f"l_{k}" for k in keys]), on, "left_anti")
    return kept.unionByName(unmatched, allowMissingColumns=True)


def added_rows(current: DataFrame, past: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``current`` whose key is absent from ``past``; a NULL key counts as absent."""
    return current.join(past.select(*keys), list(keys), "left_anti")


def lookup(fact: DataFrame, dimension: DataFrame, on: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Fact rows with dimension columns; ``on`` maps fact column to dimension column.

    No hint: Spark broadcasts the dimension when the bytes it measures are below
    the threshold, and otherwise splits hot fact keys in the sort-merge join.
    """
    d = dimension.select(
        [F.col(c).alias(f"_dim_{c}" if c in on.values() else c) for c in dimension.columns]
    )
    match = _and([F.col(f) == F.col(f"_dim_{c}") for f, c in on.items()])
    return fact.join(d, match, how).drop(*[f"_dim_{c}" for c in on.values()])


def outside_reference(df: DataFrame, column: str, allowed: DataFrame, allowed_column: str) -> DataFrame:
    """Non-NULL values of ``column`` missing from a reference table, with their row counts.

    Values are counted before the join, so a value that fills a third of the
    table joins as one row.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("row_count"))
    reference = allowed.select(F.col(allowed_column).alias("_allowed"))
    return values.join(reference, F.col(column) == F.col("_allowed"), "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the row count; NULLs count as equal."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once; NULLs count as equal."""
    dupes = duplicate_keys(df, keys).select([F.col(k).alias(f"_dup_{k}") for k in keys])
    return df.join(dupes, _and([F.col(k).eqNullSafe(F.col(f"_dup_{k}")) for k in keys]), "left_semi")


def _and(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result
