"""Daily inventory summary kept as mergeable sums and counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from opsflow.context import months_back
from opsflow.functions.dates import day
from opsflow.functions.numeric import mean
from opsflow.operators.changes import ACTION
from opsflow.schemas import SUMMARY_STATE
from opsflow.session import job_scope, staged
from opsflow.sources.tables import read_or_empty, replace_partitions

KEYS = ("snapshot_day", "warehouse_id", "sku_id", "category")
# An average cannot be merged, so the state keeps its sum and count. The counts
# beside the totals tell a total of nothing (NULL) from a total of zero, and
# ``row_count`` tells when deletions have emptied a group.
PARTS = (
    "total_received",
    "received_count",
    "total_shipped",
    "shipped_count",
    "cost_sum",
    "cost_count",
    "row_count",
)
COUNTED_TYPES = ("RECEIPT", "SHIPMENT")
STATE_TYPES = {
    "total_received": "decimal(38,4)",
    "received_count": "bigint",
    "total_shipped": "decimal(38,4)",
    "shipped_count": "bigint",
    "cost_sum": "decimal(38,4)",
    "cost_count": "bigint",
    "row_count": "bigint",
}


def summary_state(movements: DataFrame, sign: Column | None = None) -> DataFrame:
    """Sums and counts per day, warehouse, SKU and category; ``sign`` is −1 for removed rows."""
    unit = F.lit(1) if sign is None else sign
    kind, quantity, cost = F.col("transaction_type"), F.col("quantity"), F.col("unit_cost")
    received = F.when(kind == "RECEIPT", quantity).otherwise(F.lit(0))
    shipped = F.when(kind == "SHIPMENT", quantity).otherwise(F.lit(0))
    amounts = {
        "total_received": F.coalesce(received * unit, F.lit(0)),
        "received_count": received.isNotNull().cast("int") * unit,
        "total_shipped": F.coalesce(shipped * unit, F.lit(0)),
        "shipped_count": shipped.isNotNull().cast("int") * unit,
        "cost_sum": F.coalesce(cost * unit, F.lit(0)),
        "cost_count": cost.isNotNull().cast("int") * unit,
        "row_count": unit,
    }
    return (
        movements.where(kind.isin(*COUNTED_TYPES))
        .groupBy(
            F.to_date("transaction_date").alias("snapshot_day"),
            "warehouse_id",
            "sku_id",
            "category",
        )
        .agg(*[F.sum(amounts[p]).cast(STATE_TYPES[p]).alias(p) for p in PARTS])
    )


def state_of_changes(feed: DataFrame) -> DataFrame:
    """State to add for a change feed: inserts count once, deletes minus once."""
    return summary_state(feed, F.when(F.col(ACTION) == "INSERT", 1).otherwise(-1))


def merge_states(states: DataFrame) -> DataFrame:
    """One row per group from any number of partial states; emptied groups disappear."""
    return _summed(states).where(F.col("row_count") > 0)


def _summed(states: DataFrame) -> DataFrame:
    return states.groupBy(*KEYS).agg(*[F.sum(p).cast(STATE_TYPES[p]).alias(p) for p in PARTS])


def refresh(state: DataFrame, delta: DataFrame) -> DataFrame:
    """Stored state with a partial state added."""
    return merge_states(state.select(*KEYS, *PARTS).unionByName(delta.select(*KEYS, *PARTS)))


def fold(path: str, rows: DataFrame, sequence: Column, grain: str = "month") -> None:
    """Adds movements, or the changes of a feed, to the stored summary, each exactly once.

    The state is partitioned by ``grain`` (month or day) of its days and holds one row a
    group, so it never needs compaction. The partitions that the rows fall in are merged,
    stored beside the state and swapped in; the others are not opened. ``sequence`` numbers
    ascend over the whole source. Every partition carries the number up to which it is
    folded (``applied``) and passes over rows up to it: a batch that comes again, after a
    swap of some partitions or under a fresh checkpoint, is counted by those alone that lack
    it. Groups without rows stay stored, as the mark of a partition must outlive its rows.
    """
    spark = rows.sparkSession
    signs = [ACTION] if ACTION in rows.columns else []
    counted = rows.where(F.col("transaction_type").isin(*COUNTED_TYPES)).select(
        "transaction_date", *KEYS[1:], "transaction_type", "quantity", "unit_cost", *signs,
        _period(F.to_date("transaction_date"), grain).alias("_period"), sequence.cast("bigint").alias("_number"),
    )
    with job_scope(spark):
        counted = staged(counted, "counted")  # searched for its periods, then folded
        # One row for each partition touched.
        touched = counted.groupBy("_period").agg(F.max("_number").alias("upto")).collect()
        if not touched:
            return
        stored = read_or_empty(spark, path, SUMMARY_STATE).where(F.col("period").isin([r["_period"] for r in touched]))
        marks = stored.groupBy(F.col("period").alias("_of")).agg(F.max("applied").alias("_mark"))
        fresh = counted.join(marks, F.col("_period") == F.col("_of"), "left").where(
            F.col("_mark").isNull() | (F.col("_number") > F.col("_mark"))
        )
        delta = state_of_changes(fresh) if signs else summary_state(fresh)
        kept = [F.col(c).cast(SUMMARY_STATE[c].dataType).alias(c) for c in (*KEYS, *PARTS)]
        summed = _summed(stored.select(*KEYS, *PARTS).unionByName(delta.select(*kept)))
        upto = F.lit(max(r.upto for r in touched))
        folded = summed.withColumn("period", _period(F.col("snapshot_day"), grain)).join(marks, F.col("period") == F.col("_of"), "left")
        folded = folded.select(*[F.greatest("_mark", upto).alias(c) if c == "applied" else F.col(c) for c in SUMMARY_STATE.names])
        replace_partitions(staged(folded, "folded"), path, ["period"])


def _period(day: Column, grain: str) -> Column:
    """Name of a day's partition; rows without a day have one of their own, which sorts last."""
    return F.coalesce(F.date_format(day, {"month": "yyyy-MM", "day": "yyyy-MM-dd"}[grain]), F.lit("none"))


def read_state(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """The stored state, from the day ``since`` on if given; only the partitions from its month on are opened."""
    state = read_or_empty(spark, path, SUMMARY_STATE)
    if since is not None:
        state = state.where((F.col("period") >= f"{since:%Y-%m}") & (F.col("snapshot_day") >= day(since)))
    return state.where(F.col("row_count") > 0).select(*KEYS, *PARTS)


def summary_view(state: DataFrame) -> DataFrame:
    """The report columns of a state; a total without any known quantity is NULL."""
    received = F.when(F.col("received_count") > 0, F.col("total_received"))
    shipped = F.when(F.col("shipped_count") > 0, F.col("total_shipped"))
    return state.select(
        *KEYS,
        received.alias("total_received"),
        shipped.alias("total_shipped"),
        (received - shipped).cast("decimal(38,4)").alias("net_movement"),
        mean(F.col("cost_sum"), F.col("cost_count")).alias("avg_unit_cost"),
    )


def daily_summary(movements: DataFrame) -> DataFrame:
    return summary_view(summary_state(movements))


def recent_summary(summary: DataFrame, as_of: date, months: int = 3) -> DataFrame:
    """Days of the last ``months``, newest first."""
    return summary.where(F.col("snapshot_day") >= day(months_back(as_of, months))).orderBy(
        F.col("snapshot_day").desc_nulls_first(), "warehouse_id", "sku_id", "category"
    )
