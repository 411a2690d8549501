"""Near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors are projected on random Gaussian directions and quantised in steps of
``width``; ``projections`` quantised values together name a bucket, in each of ``tables``
tables. Vectors that share a bucket are compared exactly by cosine in double precision.
For unit vectors at cosine 0.95 a table finds the pair with probability 0.80 ** 8 = 0.17,
so all 32 tables together miss 0.3 % of pairs at the threshold and far fewer above it.

Equal vectors are merged first and weigh as many rows as they stand for. A pair that
shares buckets in several tables counts in the first of them. Tasks return sums of links
per vector and a spanning forest of each tile pair, so no list of pairs is ever stored.

Defined cases: a vector that is null, zero, or holds null or non-finite components links
with nothing, and so does a row without id; vectors of different length are never linked;
an id that stands with several vectors has a row for each, linked by its own vector; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsflow.llm.base import numbered
from opsflow.llm.components import components
from opsflow.llm.tiles import compare, deal, forest
from opsflow.session import staged

TILE = 1024
HITS_AT_ONCE = 1 << 16


def directions(size: int, tables: int, projections: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions and offsets of all tables, the same on every machine."""
    random = np.random.default_rng([seed, size])
    return random.standard_normal((size, tables * projections)), random.uniform(0, width, tables * projections)


def coded(vectors: DataFrame, id_col: str, vector: str, tables: int, projections: int, width: float, seed: int) -> DataFrame:
    """(id, vec, codes): components as bytes and one 32-bit bucket code per table; null codes for vectors without a direction."""
    wide = vectors.schema[vector].dataType.elementType.simpleString() != "float"

    def coding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [None if v is None or None in v else np.array(v, float) for v in batch.column(1).to_pylist()]
            codes: list[bytes | None] = [None] * len(rows)
            fine = [i for i, v in enumerate(rows) if v is not None and np.isfinite(v).all() and v.any()]
            for size in {len(rows[i]) for i in fine}:
                at = [i for i in fine if len(rows[i]) == size]
                axes, shifts = directions(size, tables, projections, width, seed)
                cells = np.floor((_normal(np.stack([rows[i] for i in at])) @ axes + shifts) / width).astype(np.int64)
                mixed = np.full((len(at), tables), size, np.int64)
                for p in range(projections):
                    mixed = mixed * 1000003 + cells.reshape(len(at), tables, projections)[:, :, p]
                mixed ^= mixed >> 29
                for i, own in zip(at, (mixed & 0x7FFFFFFF).astype("<i4")):
                    codes[i] = own.tobytes()
            bodies = [None if c is None else v.astype("<f8" if wide else "<f4").tobytes() for v, c in zip(rows, codes)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.binary()), pa.array(codes, pa.binary())],
                                             ["id", "vec", "codes"])

    return vectors.select(F.col(id_col).cast("long"), vector).mapInArrow(coding, "id long, vec binary, codes binary")


def _normal(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(1, keepdims=True)  # first, so that squares neither vanish nor overflow
    rows = rows / largest
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
                    tables: int = 32, projections: int = 8, width: float = 1.265, seed: int = 3) -> DataFrame:
    """One row per vector: its id under its own name, n_links, component_id, kept."""
    wide = vectors.schema[vector].dataType.elementType.simpleString() != "float"
    kind = "<f8" if wide else "<f4"
    rows = staged(
        coded(vectors, id_col, vector, tables, projections, width, seed)
        .withColumns({"key_a": F.xxhash64("vec"), "key_b": F.xxhash64(F.lit(1), "vec")}), "vectors"
    )
    usable = rows.where("codes is not null and id is not null")
    # Equal vectors have equal keys; min(codes) and min(vec) only pick the common value.
    classes = usable.groupBy("key_a", "key_b").agg(
        F.min("id").alias("least_id"), F.count("*").alias("weight"), F.min("vec").alias("vec"), F.min("codes").alias("codes"))
    # Numbered by their smallest ids, so that the smallest node of a component has its smallest id; one id can stand with several vectors.
    merged = staged(numbered(classes, "node", "least_id", "key_a", "key_b"), "vectors")
    parts = F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), lambda t: F.struct(
        t.alias("part"), F.conv(F.hex(F.substring("codes", t * 4 + 1, F.lit(4))), 16, 10).cast("long").alias("bucket")))
    dealt = deal(merged.select("node", F.inline(parts)), ["part", "bucket"], "node", TILE)
    carried = dealt.join(merged.select("node", "weight", "vec", "codes"), "node")

    def work(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        part, side = table.column("part").to_numpy(), table.column("side").to_numpy()
        same = table.column("tile_a").to_numpy() == table.column("tile_b").to_numpy()
        codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), "<i4").reshape(-1, tables)
        bodies = table.column("vec").to_pylist()
        out_links, out_a, out_b = {}, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, stop in zip(starts, np.append(starts[1:], len(node))):
            for size in {len(b) for b in bodies[start:stop]}:
                own = np.array([i for i in range(start, stop) if len(bodies[i]) == size])
                unit = _normal(np.frombuffer(b"".join([bodies[i] for i in own]), kind).reshape(len(own), -1).astype(float))
                left = right = np.arange(len(own))
                if not same[start]:
                    left, right = left[side[own] == 0], right[side[own] == 1]
                i, j = np.nonzero(unit[left] @ unit[right].T >= threshold)
                i, j = left[i], right[j]
                if same[start]:
                    i, j = i[i < j], j[i < j]
                i, j = own[i], own[j]
                first = _first_met(codes, i, j, part[start])
                i, j = i[first], j[first]
                if not len(i):
                    continue
                gained = np.bincount(i - start, weight[j], stop - start) + np.bincount(j - start, weight[i], stop - start)
                for at in np.flatnonzero(gained).tolist():
                    out_links[int(node[start + at])] = out_links.get(int(node[start + at]), 0) + int(gained[at])
                moved, root = forest(i - start, j - start, stop - start)
                out_a.append(node[moved + start])
                out_b.append(node[root + start])
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        n = len(out_links)
        return pa.RecordBatch.from_arrays(
            [pa.array([*out_links, *a.tolist()], pa.int64()), pa.array([None] * n + b.tolist(), pa.int64()),
             pa.array([*out_links.values(), *[0] * len(a)], pa.int64())], ["a", "b", "links"])

    found = staged(compare(carried, ["part", "bucket"], work, "a long, b long, links long"), "links")
    linked = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found.where("b is not null").select("a", "b"))
    labels = merged.select(F.col("node").alias("component"), F.col("least_id").alias("label"))
    named = joined.join(labels, "component").select("node", "label")
    placed = staged(
        merged.select("key_a", "key_b", "node", "least_id", "weight").join(linked, "node", "left").join(named, "node", "left").select(
            "key_a", "key_b", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("label", "least_id").alias("component_id")),
        "vectors",
    )
    known = usable.select("id", "key_a", "key_b").join(placed, ["key_a", "key_b"]).select("id", "n_links", "component_id")
    others = rows.where("codes is null or id is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return known.unionByName(others).withColumn("kept", F.col("id") == F.col("component_id")).withColumnRenamed("id", id_col)


def _first_met(codes: np.ndarray, i: np.ndarray, j: np.ndarray, part: int) -> np.ndarray:
    """Which of the pairs share no bucket in an earlier table."""
    met = np.ones(len(i), bool)
    for at in range(0, len(i), HITS_AT_ONCE):
        cut = slice(at, at + HITS_AT_ONCE)
        met[cut] = ~(codes[i[cut], :part] == codes[j[cut], :part]).any(1)
    return met
