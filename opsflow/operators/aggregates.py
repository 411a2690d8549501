"""Group totals kept out of windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def with_group_total(
    df: DataFrame, group: Sequence[str], value: Column, name: str, rows: DataFrame | None = None
) -> DataFrame:
    """Adds the group's sum to each row, as an aggregate joined back.

    The unordered window ``sum().over(partitionBy(group))`` gathers a group in
    one task; the aggregate combines inside the input tasks, and the join back
    is broadcast or split by AQE. ``rows`` gives the same rows from a cheaper
    place, such as the stored table ``df`` was derived from.
    """
    totals = (df if rows is None else rows).groupBy(*group).agg(F.sum(value).alias(name))
    totals = totals.select([F.col(g).alias(f"_total_{g}") for g in group] + [F.col(name)])
    match = F.lit(True)
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_total_{g}"))
    return df.join(totals, match, "left").drop(*[f"_total_{g}" for g in group])
