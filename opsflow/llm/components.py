"""Connected components of a graph given as links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsflow.session import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b: long); component is the smallest node reachable.

    A large-star step hangs all larger neighbours of a node on its smallest neighbour, a
    small-star step all smaller ones; both keep components, and after few rounds every
    component is a star around its smallest node. The smallest neighbours are aggregated
    with map-side sums and stored, so a hub's links are joined to one row and can be split
    over tasks. Only a count and a checksum come to the driver.
    """
    pairs = staged(_pairs(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "links")
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = staged(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "links")
        large = staged(_pairs(both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))), "links")
        near = staged(large.groupBy("u").agg(F.min("v").alias("m")), "links")
        small = large.join(near, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))
        pairs = staged(_pairs(small.unionByName(near.select("u", F.col("m").alias("v")))), "links")
        before, mark = mark, _mark(pairs)
        if before == mark:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.where("u <> v").distinct()


def _mark(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
