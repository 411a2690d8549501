"""Change feed between two versions of a table, merge and upsert."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.functions.dates import naive

ACTION, IS_UPDATE = "dml_action", "is_update"


def changes(before: DataFrame, after: DataFrame, key: str, append_only: bool = False) -> DataFrame:
    """Rows that turn ``before`` into ``after``.

    An update is a DELETE of the old row and an INSERT of the new one, both
    marked ``is_update``. ``key`` is unique in both versions, a NULL counting as
    one key; :func:`require_unique` checks that. ``append_only`` keeps plain inserts alone.
    """
    columns = after.columns
    old = before.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    new = after.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("_new"))
    same_key = F.col("_old_key").eqNullSafe(F.col("_new_key"))
    if append_only:
        fresh = new.join(old.select("_old_key"), same_key, "left_anti")
        return fresh.select("_new.*", F.lit("INSERT").alias(ACTION), F.lit(False).alias(IS_UPDATE))
    was, is_now = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    changed = old.join(new, same_key, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
    images = F.array_compact(
        F.array(
            F.when(was, F.struct(F.col("_old").alias("row"), F.lit("DELETE").alias(ACTION))),
            F.when(is_now, F.struct(F.col("_new").alias("row"), F.lit("INSERT").alias(ACTION))),
        )
    )
    return changed.select((was & is_now).alias(IS_UPDATE), F.explode(images).alias("_image")).select(
        "_image.row.*", f"_image.{ACTION}", IS_UPDATE
    )


def require_unique(rows: DataFrame, key: str) -> DataFrame:
    """One row per key, with all columns; two rows of one key fail the query."""
    packed = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"), F.max(F.struct(*rows.columns)).alias("_row"))
    only = F.when(F.col("_rows") == 1, F.col("_row")).otherwise(F.raise_error(F.lit(f"{key} is not unique")))
    return packed.select(only.alias("_row")).select("_row.*")


def net_changes(feed: DataFrame, key: str, sequence: str | None = None) -> DataFrame:
    """One row per key: the last image, an INSERT outranking the DELETE of its own pair.

    ``sequence`` names the column that orders a key's changes. Without it the feed must
    be a single difference of two versions, that is, at most one image of each kind per
    key; more than that has no order, and the query fails. ``replaced`` marks a key that
    was really deleted and then inserted again. The ``max`` combines inside the input
    tasks, so a key with many changes is cheap to shuffle.
    """
    values = [c for c in feed.columns if c not in (key, ACTION, IS_UPDATE, sequence)]
    is_insert = F.col(ACTION) == "INSERT"
    place = [F.col(sequence).alias("_seq")] if sequence else []
    last = F.max(F.struct(*place, is_insert.alias("_ins"), F.col(IS_UPDATE).alias("_upd"), *values))
    dropped = F.bool_or((F.col(ACTION) == "DELETE") & ~F.col(IS_UPDATE))
    most = F.greatest(F.count_if(is_insert), F.count_if(~is_insert))
    netted = feed.groupBy(key).agg(last.alias("_last"), dropped.alias("_dropped"), most.alias("_most"))
    if not sequence:
        netted = netted.withColumn("_last", F.when(F.col("_most") <= 1, F.col("_last")).otherwise(
            F.raise_error(F.lit("several changes of one key need an order column"))))
    return (
        netted.select(
            key,
            *[F.col("_last")[c].alias(c) for c in values],
            F.when(F.col("_last._ins"), "INSERT").otherwise("DELETE").alias(ACTION),
            F.col("_last._upd").alias(IS_UPDATE),
            (F.col("_last._ins") & F.col("_dropped")).alias("replaced"),
        )
    )


# What one key's changes do to its row. A DELETE leaves nothing; a re-inserted key
# takes the whole new row; an update sets the update columns and the stamp; a
# plain INSERT on an existing row changes nothing. Without a row in the target,
# everything but a DELETE inserts.
DROP, REPLACE, UPDATE, INSERT = "DROP", "REPLACE", "UPDATE", "INSERT"
KEEP = "KEEP"


def operations(net: DataFrame, key: str, stamp_column: str, stamp: Column) -> DataFrame:
    """Netted changes as (key, ``op``, ``row``), the row holding all other columns and the stamp."""
    values = [c for c in net.columns if c not in (key, ACTION, IS_UPDATE, "replaced")]
    op = (
        F.when(F.col(ACTION) == "DELETE", DROP)
        .when(F.col("replaced"), REPLACE)
        .when(F.col(IS_UPDATE), UPDATE)
        .otherwise(INSERT)
    )
    return net.select(key, op.alias("op"), F.struct(*values, stamp.alias(stamp_column)).alias("row"))


def effects(ops: DataFrame, key: str) -> DataFrame:
    """The outcome of one operation per key, for a key with a row and for one without.

    ``if_present`` is KEEP, UPDATE, REPLACE or DROP; ``present_row`` is what a
    REPLACE takes and ``present_values`` where update columns come from.
    ``if_absent`` says whether a row appears, from ``absent_row`` and ``absent_values``.
    """
    op, row = F.col("op"), F.col("row")
    return ops.select(
        key,
        F.when(op == INSERT, KEEP).otherwise(op).alias("if_present"),
        row.alias("present_row"),
        row.alias("present_values"),
        (op != DROP).alias("if_absent"),
        row.alias("absent_row"),
        row.alias("absent_values"),
    )


def apply_effects(
    target: DataFrame, outcome: DataFrame, key: str, update_columns: Sequence[str], stamp_column: str
) -> DataFrame:
    """Target after the changes, plus ``_deleted`` for the rows they removed.

    The key is unique on both sides, so no key of this join is hot; a NULL key
    matches nothing.
    """
    t = target.select(F.lit(True).alias("_in"), *[F.col(c).alias(f"_t_{c}") for c in target.columns])
    joined = t.join(outcome, F.col(f"_t_{key}") == F.col(key), "full_outer")
    present = F.col("_in").isNotNull()
    rest = [c for c in target.columns if c != key]
    return joined.where(present | F.col("if_absent")).select(
        F.when(present, F.col(f"_t_{key}")).otherwise(F.col(key)).alias(key),
        *[
            F.when(present, _kept(c, update_columns, stamp_column)).otherwise(_born(c, update_columns, stamp_column)).alias(c)
            for c in rest
        ],
        F.coalesce(present & (F.col("if_present") == DROP), F.lit(False)).alias("_deleted"),
    ).select(*target.columns, "_deleted")


def _kept(column: str, update_columns: Sequence[str], stamp_column: str) -> Column:
    """Value of a column for a key that had a row."""
    if column in update_columns or column == stamp_column:
        changed, fresh = F.col("if_present").isin(UPDATE, REPLACE), F.col("present_values")[column]
    else:
        changed, fresh = F.col("if_present") == REPLACE, F.col("present_row")[column]
    return F.when(changed, fresh).otherwise(F.col(f"_t_{column}"))


def _born(column: str, update_columns: Sequence[str], stamp_column: str) -> Column:
    """Value of a column for a key that had none."""
    source = "absent_values" if column in update_columns or column == stamp_column else "absent_row"
    return F.col(source)[column]


def merge_changes(
    target: DataFrame,
    feed: DataFrame,
    key: str,
    update_columns: Sequence[str],
    run_ts: datetime,
    stamp_column: str = "last_updated_ts",
    sequence: str | None = None,
) -> DataFrame:
    """New version of ``target`` with delete, update and insert clauses applied."""
    ops = operations(net_changes(feed, key, sequence), key, stamp_column, naive(run_ts))
    merged = apply_effects(target, effects(ops, key), key, update_columns, stamp_column)
    return merged.where(~F.col("_deleted")).drop("_deleted")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    run_ts: datetime,
    stamp_column: str = "updated_at",
) -> DataFrame:
    """``target`` with ``source`` rows updated or added; keys are unique on both sides."""
    t = target.select([F.col(c).alias(f"_t_{c}") for c in target.columns])
    s = source.select(F.lit(True).alias("_in_s"), *[F.col(c).alias(f"_s_{c}") for c in [*keys, *update_columns]])
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"_t_{k}") == F.col(f"_s_{k}"))
    joined = t.join(s, on, "full_outer")
    from_source = F.col("_in_s").isNotNull()

    def pick(column: str) -> Column:
        if column in keys:
            return F.coalesce(f"_t_{column}", f"_s_{column}").alias(column)
        if column == stamp_column:
            return F.when(from_source, naive(run_ts)).otherwise(F.col(f"_t_{column}")).alias(column)
        if column in update_columns:
            return F.when(from_source, F.col(f"_s_{column}")).otherwise(F.col(f"_t_{column}")).alias(column)
        return F.col(f"_t_{column}").alias(column)

    return joined.select([pick(c) for c in target.columns])

