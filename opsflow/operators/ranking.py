"""Row numbers, ranks and quartiles for groups of any size, and top-k per group.

A plain ``row_number().over(partitionBy(g))`` sorts the whole of ``g`` in one
task, and ``ntile`` without a partition sorts the whole table in one task. The
functions here range-partition on (group, order) instead, so that a large group
is cut into several pieces, number the rows inside each piece, and add the rows
found in earlier pieces of the same group. Only that carry, at most one row per
piece, is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsflow.session import staged

_PIECE, _LOCAL, _CARRY = "_piece", "_local", "_carry"


def cut_into_pieces(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` plus ``_piece``: pieces follow the (group, order) order and split large groups.

    The piece numbers come from sampled range bounds, so they are written down
    once; reading them from a second evaluation could give other bounds.
    """
    keys = [F.col(g).asc() for g in group] + list(order)
    return staged(df.repartitionByRange(*keys).withColumn(_PIECE, F.spark_partition_id()), "pieces")


def carried_rows(pieces: DataFrame, group: Sequence[str], value: Column | None = None) -> DataFrame:
    """Per (group, piece), the ``value`` total (default: row count) of the group's earlier pieces.

    Only a group that started in an earlier piece has a carry, and a piece can
    continue at most one such group, so this holds at most one row per piece.
    """
    amount = F.count("*") if value is None else F.sum(value)
    earlier = Window.partitionBy(*group).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    return (
        pieces.groupBy(*group, _PIECE)
        .agg(amount.alias("_amount"))
        .withColumn(_CARRY, F.sum("_amount").over(earlier))
        .where(F.col(_CARRY).isNotNull())
        .select(*group, _PIECE, _CARRY)
    )


def join_carry(df: DataFrame, carry: DataFrame, group: Sequence[str]) -> DataFrame:
    renamed = carry.select(
        *[F.col(g).alias(f"_carry_{g}") for g in group],
        F.col(_PIECE).alias("_carry_piece"),
        _CARRY,
    )
    match = F.col(_PIECE) == F.col("_carry_piece")
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_carry_{g}"))
    return df.join(F.broadcast(renamed), match, "left").drop("_carry_piece", *[f"_carry_{g}" for g in group])


def number_pieces(
    pieces: DataFrame, group: Sequence[str], order: Sequence[Column], position: str
) -> DataFrame:
    """Adds ``position``, the 1-based row number inside the group."""
    inside = Window.partitionBy(*group, _PIECE).orderBy(*order)
    numbered = pieces.withColumn(_LOCAL, F.row_number().over(inside))
    return (
        join_carry(numbered, carried_rows(pieces, group), group)
        .withColumn(position, F.col(_LOCAL).cast("bigint") + F.coalesce(_CARRY, F.lit(0)).cast("bigint"))
        .drop(_LOCAL, _CARRY)
    )


def row_number_at_scale(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], position: str
) -> DataFrame:
    """``row_number`` over a total order, whatever the size of the largest group."""
    pieces = cut_into_pieces(df, group, order)
    return number_pieces(pieces, group, order, position).drop(_PIECE)


def rank_at_scale(
    df: DataFrame, group: Sequence[str], value: str, ties: Sequence[Column], rank: str
) -> DataFrame:
    """``rank`` with gaps by ``value`` descending, NULL first; ``ties`` makes the order total.

    Rows of one value share the position of the first of them. A run of equal
    values that crosses pieces starts in an earlier piece; there is at most one
    such run per piece boundary, and their starts are broadcast.
    """
    order = [F.col(value).desc_nulls_first(), *ties]
    pieces = cut_into_pieces(df, group, order)
    numbered = number_pieces(pieces, group, order, "_position")
    local_start = F.min("_position").over(Window.partitionBy(*group, value, _PIECE))
    crossing = (
        numbered.groupBy(*group, value)
        .agg(
            F.min("_position").alias("_run_start"),
            F.min(_PIECE).alias("_first"),
            F.max(_PIECE).alias("_last"),
        )
        .where(F.col("_last") > F.col("_first"))
        .select(*[F.col(g).alias(f"_run_{g}") for g in group], F.col(value).alias("_run_value"), "_run_start")
    )
    match = F.col(value).eqNullSafe(F.col("_run_value"))
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_run_{g}"))
    return (
        numbered.withColumn("_start", local_start)
        .join(F.broadcast(crossing), match, "left")
        .withColumn(rank, F.coalesce("_run_start", "_start"))
        .drop("_position", "_start", "_run_start", "_run_value", _PIECE, *[f"_run_{g}" for g in group])
    )


def ntile_at_scale(df: DataFrame, buckets: int, order: Sequence[Column], tile: str) -> DataFrame:
    """``ntile(buckets)`` over the whole table: the first ``n % buckets`` tiles hold one row more."""
    pieces = cut_into_pieces(df, [], order)
    # One row per piece, so these two unpartitioned windows stay small.
    whole = Window.partitionBy()
    sizes = (
        pieces.groupBy(F.col(_PIECE).alias("_size_piece"))
        .agg(F.count("*").alias("_amount"))
        .withColumns(
            {
                "_total": F.sum("_amount").over(whole),
                "_through": F.sum("_amount").over(whole.orderBy("_size_piece")),
            }
        )
        .select("_size_piece", "_total", (F.col("_through") - F.col("_amount")).alias("_before"))
    )
    local = F.row_number().over(Window.partitionBy(_PIECE).orderBy(*order))
    index = F.col("_before") + F.col(_LOCAL) - 1
    small = F.floor(F.col("_total") / buckets).cast("bigint")
    longer = F.col("_total") % buckets
    in_longer = longer * (small + 1)
    return (
        pieces.withColumn(_LOCAL, local)
        .join(F.broadcast(sizes), F.col(_PIECE) == F.col("_size_piece"))
        .withColumn(
            tile,
            F.when(index < in_longer, F.floor(index / (small + 1)))
            .otherwise(longer + F.floor((index - in_longer) / F.greatest(small, F.lit(1))))
            .cast("bigint")
            + 1,
        )
        .drop(_LOCAL, _PIECE, "_size_piece", "_total", "_before")
    )


def running_sum_at_scale(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], value: str, total: str
) -> DataFrame:
    """Running sum of ``value`` along ``order``, for groups of any size."""
    pieces = cut_into_pieces(df, group, order)
    inside = (
        Window.partitionBy(*group, _PIECE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = pieces.withColumn(_LOCAL, F.sum(value).over(inside))
    return (
        join_carry(summed, carried_rows(pieces, group, F.col(value)), group)
        .withColumn(total, F.col(_LOCAL) + F.coalesce(F.col(_CARRY), F.lit(0)))
        .drop(_LOCAL, _CARRY, _PIECE)
    )


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, position: str = "rn") -> DataFrame:
    """The first ``k`` rows of each group.

    The filter on the row number lets Spark cut every group to ``k`` rows inside
    each input task before the shuffle, so a large group never travels whole.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(position, F.row_number().over(window)).where(F.col(position) <= k)
