"""Hard negatives by tiled exact scores and mergeable heaps.

Anchors are a stated set of rows; they are worked in blocks of about ``block``, and only a
block's vectors and, later, its positives pass the driver. Every task multiplies the
block with its own rows, a tile at a time, by ``strassen.product``:

1. Positives: a task keeps, for each anchor, a heap of the best rows of the anchor's label;
   the heaps of all tasks are merged to the first ``positives`` rows.
2. Negatives: a positive's score gives a window of scores. A task keeps, for each
   anchor and positive, a heap of the best rows of other labels inside the window;
   merged, they give the first ``negatives``.

Heaps hold at most their own number of rows and merge in any order, so a label that holds
most rows costs no more than others, and no group of rows is ever gathered.

Defined cases: rows without id, label or vector, or with a null or non-finite component,
take no part; rows equal in id, label and vector count once; an id that stands with several
labels or vectors is a row, and an anchor, with each; rows of the anchor's own id are
neither its positives nor its negatives; only vectors of the anchor's length are compared;
an anchor without positives, or whose windows are empty, has no row; ties go to the smaller
id; an empty table gives an empty result. Scores beyond 64 bits fail the query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsflow.llm.strassen import product
from opsflow.session import staged, work_path

TILE = 2048
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class Heaps:
    """The first ``size`` (score, id) of many keys: highest score first, then smallest id."""

    def __init__(self, keys: int, size: int):
        self.size = size
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        #: The last score of every full heap; what lies below cannot enter.
        self.least = np.full(keys, np.iinfo(np.int64).min)

    def push(self, key: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        good = score >= self.least[key]
        key, score, id_ = key[good], score[good], id_[good]
        if not len(key):
            return
        key, score, id_ = (np.concatenate(p) for p in ((self.key, key), (self.score, score), (self.id, id_)))
        order = np.lexsort((id_, -score, key))
        key, score, id_ = key[order], score[order], id_[order]
        first = np.searchsorted(key, key)
        place = np.arange(len(key)) - first
        kept = place < self.size
        self.key, self.score, self.id = key[kept], score[kept], id_[kept]
        last = place == self.size - 1
        self.least[key[last]] = score[last]


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         id_col: str = "vec_id", vector: str = "vector", label: str = "label", block: int = 1024) -> DataFrame:
    """For each anchor and positive the first ``negatives`` rows of another label whose score is ``low`` to ``high`` % of the positive's.

    ``vector`` is an array of longs. Columns: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.
    """
    spark = vectors.sparkSession
    usable = F.col(id_col).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, F.isnull)
    rows = staged(
        vectors.where(usable).select(
            F.col(id_col).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vec"),
            F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        ).distinct(), "negative-rows",
    )
    anchors = rows.where("asks").withColumn("length", F.size("vec"))
    path = work_path(spark, "negatives")
    for length, count in sorted((r.length, r["count"]) for r in anchors.groupBy("length").count().collect()):
        blocks = -(-count // block)
        own = rows.where(F.size("vec") == length).select("id", "label", "vec")
        for b in range(blocks):
            got = anchors.where((F.col("length") == length) & (F.pmod(F.xxhash64("id", "label", "vec"), F.lit(blocks)) == b)).collect()
            if got:
                got.sort(key=lambda r: (r.id, r.label, r.vec))
                _mined(own, got, positives, negatives, low, high).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path) if anchors.limit(1).count() else spark.createDataFrame([], RESULT)


def _mined(own: DataFrame, got: list, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The result for one block of anchors."""
    ids, labels = (np.array([r[name] for r in got], np.int64) for name in ("id", "label"))
    asks = np.array([r.vec for r in got], np.int64).reshape(len(got), len(got[0].vec))

    def same_label(other: np.ndarray, tags: np.ndarray, scores: np.ndarray, heaps: Heaps) -> None:
        place, row = np.nonzero((labels[:, None] == tags) & (ids[:, None] != other) & (scores >= heaps.least[:, None]))
        heaps.push(place, scores[place, row], other[row])

    best = _first(_heaped(own, asks, same_label, len(got), positives), positives)
    # At most ``positives`` rows an anchor; slot: place of an anchor and positive in these arrays.
    chosen = sorted(((r.key, r.rank, r.id, r.score) for r in best.collect()))
    slots = [(key, id_, score, -(-low * score // 100), high * score // 100) for key, _, id_, score in chosen]
    ranks = np.array([r for _, r, _, _ in chosen], np.int64)
    place_of, positive, score_of, least, most = (np.array([s[i] for s in slots], np.int64) for i in range(5))

    def in_window(other: np.ndarray, tags: np.ndarray, scores: np.ndarray, heaps: Heaps) -> None:
        apart = (labels[:, None] != tags) & (ids[:, None] != other)
        for rank in range(1, positives + 1):
            slot = np.flatnonzero(ranks == rank)
            mine, floor = scores[place_of[slot]], np.maximum(least[slot], heaps.least[slot])
            at, row = np.nonzero(apart[place_of[slot]] & (mine >= floor[:, None]) & (mine <= most[slot][:, None]))
            heaps.push(slot[at], mine[at, row], other[row])

    found = _first(_heaped(own, asks, in_window, len(slots), negatives), negatives)
    named = own.sparkSession.createDataFrame(
        [(i, int(ids[p]), int(q), int(s)) for i, (p, q, s) in enumerate(zip(place_of, positive, score_of))],
        "key long, anchor_id long, positive_id long, positive_score long")
    return found.join(named, "key").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _heaped(own: DataFrame, asks: np.ndarray, enter: Callable, keys: int, size: int) -> DataFrame:
    """Every task's heaps (key, score, id), filled by ``enter`` tile by tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(keys, size)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            rows = batch.column(2).flatten().to_numpy().reshape(len(ids), asks.shape[1])
            for at in range(0, len(ids), TILE):
                cut = slice(at, at + TILE)
                enter(ids[cut], tags[cut], product(asks, np.ascontiguousarray(rows[cut].T)), heaps)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (heaps.key, heaps.score, heaps.id)], ["key", "score", "id"])

    return own.mapInArrow(run, "key long, score long, id long")


def _first(heaps: DataFrame, size: int) -> DataFrame:
    """The heaps of all tasks merged, with ranks; a task's heap is short, so a key meets one short list a task."""
    order = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
