"""Comparison of all rows within groups of any size, in tiles of bounded size.

A group is cut into tiles, and every pair of tiles that can hold a match becomes one unit
of work of at most two tiles. So a task never holds a whole group, and a hot group is
spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsflow.session import staged

# Rows and bytes that are gathered before they are worked, beyond the unit that they end in.
ROWS_AT_ONCE, BYTES_AT_ONCE = 1 << 15, 64 << 20


def deal(rows: DataFrame, keys: list[str], salt: str, tile: int, band: str | None = None) -> DataFrame:
    """``rows`` once for each tile pair they belong to, with tile_a <= tile_b and ``side`` (0: in tile_a).

    A group of up to ``tile`` rows is one tile. A larger one is cut by ``band``, so that
    only tiles of the same or neighbouring bands meet, and by a hash of ``salt`` into tiles
    of about ``tile`` rows. Rows alone in their group are left out. The tile counts are one
    row per group, with one entry per band.
    """
    rows = rows.withColumn("tile_band", F.col(band).cast("int") if band else F.lit(0))
    sizes = rows.groupBy(*keys, "tile_band").agg(F.count("*").alias("n")).groupBy(*keys).agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("tile_band", "n")).alias("bands")
    )
    cut = F.transform("bands", lambda b: F.struct(
        b["tile_band"].cast("long").alias("band"), F.ceil(b["n"] / F.lit(tile)).cast("int").alias("k")))
    one = F.array(F.struct(F.lit(0).cast("long").alias("band"), F.lit(1).alias("k")))
    small = F.col("total") <= tile
    groups = staged(
        sizes.where("total > 1").select(*keys, small.alias("small"), F.when(small, one).otherwise(cut).alias("tiles")), "tiles"
    )
    own = F.when(F.col("small"), 0).otherwise(F.col("tile_band")).cast("long")
    joined = rows.join(groups, keys).withColumn("own", own)
    mine = F.filter("tiles", lambda t: t["band"] == F.col("own"))[0]["k"]
    joined = joined.withColumn("mine", F.col("own") * (1 << 32) + F.pmod(F.xxhash64(salt), mine))
    partners = F.flatten(F.transform(
        F.filter("tiles", lambda t: F.abs(t["band"] - F.col("own")) <= 1),
        lambda t: F.transform(F.sequence(F.lit(0), t["k"] - 1), lambda s: t["band"] * (1 << 32) + s),
    ))
    met = joined.withColumn("other", F.explode(partners))
    return met.select(
        *[c for c in rows.columns if c != "tile_band"],
        F.least("mine", "other").alias("tile_a"), F.greatest("mine", "other").alias("tile_b"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"),
    )


def compare(dealt: DataFrame, keys: list[str], work: Callable[[pa.Table, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """Runs ``work`` over the dealt rows; it gets a table of whole units and the place at which each begins."""
    unit = [*keys, "tile_a", "tile_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= ROWS_AT_ONCE or sum(b.nbytes for b in held) >= BYTES_AT_ONCE:
                rows = pa.Table.from_batches(held)
                starts = _starts(rows, unit)
                held = rows.slice(starts[-1]).combine_chunks().to_batches()
                if starts[-1]:
                    yield work(rows.slice(0, starts[-1]), starts[:-1])
        if held:
            rows = pa.Table.from_batches(held)
            yield work(rows, _starts(rows, unit))

    return dealt.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, schema)


def _starts(rows: pa.Table, unit: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for name in unit:
        values = rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def forest(left: np.ndarray, right: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that connect what the given links connect, at most one per node."""
    label = np.arange(nodes)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(nodes))
    return moved, label[moved]
