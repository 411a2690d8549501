"""Overlaps of intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsflow.operators.ranking import running_sum_at_scale


def with_overlap(spans: DataFrame, low: str, high: str, name: str = "depth") -> DataFrame:
    """Adds to each span how many spans, itself included, cover its ``low``; both bounds belong to a span.

    Starts and ends are counted by value first, so the running sum goes over distinct
    bounds and not over spans; a span that ends at a value still covers it.
    """
    starts = spans.select(F.col(low).alias("_at"), F.lit(1).alias("_opened"), F.lit(0).alias("_closed"))
    ends = spans.select(F.col(high).alias("_at"), F.lit(0).alias("_opened"), F.lit(1).alias("_closed"))
    bounds = starts.unionByName(ends).groupBy("_at").agg(F.sum("_opened").alias("_opened"), F.sum("_closed").alias("_closed"))
    steps = bounds.withColumn("_step", F.col("_opened") - F.col("_closed"))
    swept = running_sum_at_scale(steps, [], [F.col("_at").asc()], "_step", "_open")
    covering = swept.where("_opened > 0").select(F.col("_at"), (F.col("_open") + F.col("_closed")).alias(name))
    return spans.join(covering, F.col(low).eqNullSafe(F.col("_at")), "left").drop("_at")
