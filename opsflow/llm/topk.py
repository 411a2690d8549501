"""Exact top-k by inner product, by a three-phase uniform threshold.

The components of every vector are cut into lists; a row's score is the sum of its partial
scores over the lists. For a block of queries:

1. Each task gathers, for every query and list, its local list of best partial scores. The
   best ``depth`` * (k + 1) entries of all tasks are scored exactly; the last of the k + 1
   best is a score that the true answer reaches too.
2. That safe score, shared evenly among the lists, is broadcast as a cutoff per query. A
   row below the cutoff in every list has a smaller sum, so it cannot be in the answer.
   The tasks collect every entry at or above the cutoff.
3. Rows whose entries are complete are summed; the remaining ones are scored exactly.

Equal vectors are merged to one row with the smallest k + 1 ids. Queries are a stated set
and are worked in blocks of about ``block`` distinct vectors, which alone, with one number
per query, pass the driver. Scores are integers throughout.

Defined cases: vectors that are null or hold null or non-finite components, and rows
without id, take no part; only vectors of the query's own length are its candidates; of
rows that repeat the query's id and vector, one counts as the query's own; an id that stands
with several vectors is a row, and a query, with each of them; a query with
fewer candidates gets them all; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsflow.llm.base import numbered
from opsflow.session import staged, work_path

ROWS_AT_ONCE = 2048
EXACT = 2.0**53
ENTRY = "place int, list int, node long, score long"


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, in double precision; null for vectors that take no part.

    A component that doubles cannot hold to the unit after scaling fails the query.
    """
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.transform(vector, lambda x: _floored(x.cast("double") * scale)))


def _floored(scaled: Column) -> Column:
    return F.when(F.abs(scaled) < EXACT, F.floor(scaled)).otherwise(F.raise_error(F.lit("a vector component is too large")))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of one with all rows of the other."""
    largest = [float(np.abs(x.astype(float)).max()) if x.size else 0.0 for x in (left, right)]
    if largest[0] * largest[1] * max(1, left.shape[1]) < EXACT:
        return (left.astype(float) @ right.T.astype(float)).astype(np.int64)
    if largest[0] * largest[1] * max(1, left.shape[1]) >= 2.0**63:
        raise OverflowError("inner products may not fit into 64 bits")
    return left @ right.T


def search(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector: str = "vector",
           lists: int = 2, block: int = 1024, depth: int = 16) -> DataFrame:
    """The ``k`` best rows for every row with ``is_query``: query_id, rank, id (under its own name), score.

    ``vector`` is an array of longs. Ties go to the smaller id.
    """
    spark = vectors.sparkSession
    rows = staged(
        vectors.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull()).select(
            F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"),
            F.xxhash64(vector).alias("key_a"), F.xxhash64(F.lit(1), vector).alias("key_b"),
        ), "search-rows",
    )
    place = F.row_number().over(Window.partitionBy("key_a", "key_b").orderBy("id"))
    members = rows.drop("asks").withColumn("place", place).where(F.col("place") <= k + 1)
    classes = members.groupBy("key_a", "key_b").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.min("vec").alias("vec"))
    # Numbered by their smallest ids, for ties; one id can stand with several vectors.
    merged = staged(numbered(classes, "node", F.col("ids")[0], "key_a", "key_b"), "search-classes")
    asked = rows.where("asks").select("id", "key_a", "key_b")
    wanted = staged(
        merged.join(asked.select("key_a", "key_b").distinct(), ["key_a", "key_b"], "left_semi")
        .select("node", "vec", F.size("vec").alias("length")), "search-queries",
    )
    path = work_path(spark, "search-results")
    for length, count in sorted((r.length, r["count"]) for r in wanted.groupBy("length").count().collect()):
        blocks = -(-count // block)
        own = merged.where(F.size("vec") == length).select("node", "vec")
        for b in range(blocks):
            picked = wanted.where((F.col("length") == length) & (F.pmod(F.xxhash64("node"), F.lit(blocks)) == b)).orderBy("node")
            got = picked.select("node", "vec").collect()
            if got:
                nodes = np.array([r.node for r in got], np.int64)
                asks = np.array([r.vec for r in got], np.int64).reshape(len(got), length)
                _answered(own, nodes, asks, k + 1, min(lists, max(1, length)), depth).write.mode("append").parquet(path)
    schema = "query long, node long, score long"
    found = spark.read.schema(schema).parquet(path) if wanted.limit(1).count() else spark.createDataFrame([], schema)
    best = (
        found.join(merged.select("node", "ids"), "node")
        .select("query", F.explode("ids").alias("id"), "node", "score")
        .groupBy("query").agg(F.collect_list(F.struct((-F.col("score")).alias("less"), "id", "node")).alias("best"))
    )
    best = staged(best.withColumnRenamed("query", "own"), "search-best")
    queries = asked.join(merged.select("key_a", "key_b", F.col("node").alias("own")), ["key_a", "key_b"]).join(best, "own")
    itself = F.array_position(F.transform("best", lambda x: (x["id"] == F.col("id")) & (x["node"] == F.col("own"))), True)
    ranked = queries.withColumn("best", F.array_sort("best")).withColumn("itself", itself)
    others = F.slice(F.filter("best", lambda x, i: i + 1 != F.col("itself")), 1, k)
    return ranked.select(F.col("id").alias("query_id"), F.posexplode(others).alias("rank", "hit")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.id").alias(id_col), (-F.col("hit.less")).alias("score")
    )


def _answered(own: DataFrame, nodes: np.ndarray, asks: np.ndarray, k: int, lists: int, depth: int) -> DataFrame:
    """The k best classes (query, node, score) for one block of queries."""
    length, wide = asks.shape[1], depth * k
    cuts = np.linspace(0, length, lists + 1).astype(int).tolist()
    listed = own.select("node", F.inline(F.array(*[
        F.struct(F.lit(j).alias("list"), F.slice("vec", cuts[j] + 1, cuts[j + 1] - cuts[j]).alias("part")) for j in range(lists)
    ])))
    at = Window.partitionBy("place", "list").orderBy(F.desc("score"), "node")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = {j: (np.zeros((len(asks), 0), np.int64), np.zeros((len(asks), 0), np.int64)) for j in range(lists)}
        for j, ids, scores in _partials(batches, asks, cuts):
            best, who = tops[j]
            best = np.concatenate([best, scores], 1)
            who = np.concatenate([who, np.broadcast_to(ids, scores.shape)], 1)
            if best.shape[1] > wide:
                pick = np.argpartition(-best, wide - 1, 1)[:, :wide]
                best, who = np.take_along_axis(best, pick, 1), np.take_along_axis(who, pick, 1)
            tops[j] = best, who
        for j, (best, who) in tops.items():
            yield _batch(np.repeat(np.arange(len(asks)), best.shape[1]), j, who.ravel(), best.ravel())

    gathered = listed.mapInArrow(local, ENTRY)
    first = gathered.withColumn("at", F.row_number().over(at)).where(F.col("at") <= wide).select("place", "node").distinct()
    exact = _scored(first, own, asks)
    order = Window.partitionBy("place").orderBy(F.desc("score"))
    safe = exact.withColumn("at", F.row_number().over(order)).where(F.col("at") == k).select("place", "score")
    cutoff = np.full(len(asks), -np.inf)
    for r in safe.collect():  # one row per query of the block
        cutoff[r.place] = r.score / lists - 0.5  # half a point below, against rounding

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for j, ids, scores in _partials(batches, asks, cuts):
            place, row = np.nonzero(scores >= cutoff[:, None])
            yield _batch(place, j, ids[row], scores[place, row])

    entries = listed.mapInArrow(enough, ENTRY)
    sums = staged(entries.groupBy("place", "node").agg(F.sum("score").alias("score"), F.count("*").alias("n")), "search-entries")
    rest = _scored(sums.where(F.col("n") < lists).select("place", "node"), own, asks)
    scored = sums.where(F.col("n") == lists).select("place", "node", "score").unionByName(rest)
    last = Window.partitionBy("place").orderBy(F.desc("score"), "node")
    kept = scored.withColumn("at", F.row_number().over(last)).where(F.col("at") <= k)
    known = F.array(*[F.lit(int(n)) for n in nodes]) if len(nodes) <= 64 else None
    if known is not None:
        return kept.select(F.element_at(known, F.col("place") + 1).alias("query"), "node", "score")
    named = own.sparkSession.createDataFrame(list(enumerate(nodes.tolist())), "place int, query long")
    return kept.join(named, "place").select("query", "node", "score")


def _batch(place, j, node, score) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(place, np.int32)), pa.array(np.full(len(place), j, np.int32)), pa.array(np.asarray(node, np.int64)),
         pa.array(np.asarray(score, np.int64))], ["place", "list", "node", "score"])


def _partials(batches: Iterator[pa.RecordBatch], asks: np.ndarray, cuts: list[int]):
    """(list, ids, partial scores of all queries with them), a strip of rows at a time."""
    for batch in batches:
        which = batch.column("list").to_numpy()
        for j in np.unique(which).tolist():
            own = batch.filter(pa.array(which == j))
            ids, width = own.column("node").to_numpy(), cuts[j + 1] - cuts[j]
            rows = own.column("part").flatten().to_numpy().reshape(len(ids), width)
            for at in range(0, len(ids), ROWS_AT_ONCE):
                strip = slice(at, at + ROWS_AT_ONCE)
                yield j, ids[strip], products(asks[:, cuts[j] : cuts[j + 1]], rows[strip])


def _scored(pairs: DataFrame, own: DataFrame, asks: np.ndarray) -> DataFrame:
    """Exact scores of (place, node) pairs; each vector is read once, with the block's queries that want it."""
    wanted = pairs.groupBy("node").agg(F.collect_list("place").alias("places"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places = batch.column("places")
            counts = np.diff(places.offsets.to_numpy())
            which, row = places.flatten().to_numpy(), np.repeat(np.arange(len(counts)), counts)
            rows = batch.column("vec").flatten().to_numpy().reshape(len(counts), -1)
            scores = np.concatenate([
                _rowwise(asks[which[at : at + 8 * ROWS_AT_ONCE]], rows[row[at : at + 8 * ROWS_AT_ONCE]])
                for at in range(0, len(which), 8 * ROWS_AT_ONCE)
            ])
            yield pa.RecordBatch.from_arrays(
                [pa.array(which.astype(np.int32)), pa.array(batch.column("node").to_numpy()[row]), pa.array(scores)],
                ["place", "node", "score"])

    joined = wanted.join(own, "node").select("node", "vec", "places")
    return joined.mapInArrow(score, "place int, node long, score long")


def _rowwise(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(1)
