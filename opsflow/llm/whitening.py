"""Whitening of integer vectors along the leading eigenvectors of their covariance.

The covariance is never formed: ``jacobi_davidson.largest_pairs`` asks for its products
with a few vectors, and each product is one Spark job over the fit list, whose tasks
centre their rows, multiply, and send back one small matrix. What reaches the driver grows
with the length of the vectors, not with their number: the matrices of a large fit list
are first summed in ``GROUPS`` groups.

The fit list holds each distinct vector once. Means and deviations are exact: rows are
shifted by the rounded mean, and n * x - S is formed in integers.

Defined cases: rows whose vector is null or holds null or non-finite components are left
out, and so are vectors whose length is not the commonest one (the longest, of equally
common ones); a null id is kept like any other; repeated rows weigh once in the fit and each
has its results; directions without variance (an eigenvalue under 1e-12 of the sum of all)
give no component, so one distinct vector, or none, gives an empty result. Numbers that do
not fit into 64 bits fail the query.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsflow.llm.jacobi_davidson import largest_pairs
from opsflow.session import staged

GROUPS = 64
#: Fit lists of more vectors have their tasks' matrices summed in groups first.
VECTORS_DIRECT = 1 << 22
ROWS_AT_ONCE = 1024


@dataclass
class Whitener:
    """``middle`` + ``rest`` / n is the mean; ``axes``: one unit eigenvector a column, for falling ``values``."""

    n: int
    middle: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    axes: np.ndarray
    trace: float
    identity_error: float = math.nan

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """n * x - S, exactly."""
        near = rows - self.middle
        if (float(np.abs(near).max(initial=0)) + 1) * self.n >= 2.0**62:
            raise OverflowError("deviations do not fit into 64 bits")
        return near * self.n - self.rest

    def deviations(self, rows: np.ndarray) -> np.ndarray:
        """Sum of (n * x - S) ** 2 over the dimensions, exactly."""
        away = self.centred(rows)
        if float(np.abs(away).max(initial=0)) ** 2 * max(1, rows.shape[1]) >= 2.0**63:
            exact = [sum(a * a for a in row) for row in away.tolist()]
            if max(exact) >= 1 << 63:
                raise OverflowError("deviations do not fit into 64 bits")
            return np.array(exact, np.int64)
        return (away * away).sum(1)

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.centred(rows) / self.n @ self.axes / np.sqrt(self.values)


def _rows(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, length)


def _summed(fit: DataFrame, length: int, shape: tuple[int, ...], work: Callable[[np.ndarray], np.ndarray], large: bool) -> np.ndarray:
    """The sum over all rows of the fit list of ``work`` on blocks of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, lost = np.zeros(shape), np.zeros(shape)
        for batch in batches:
            rows = _rows(batch, length)
            for at in range(0, len(rows), ROWS_AT_ONCE):
                # Compensated, so that the error does not grow with the number of blocks.
                part = work(rows[at : at + ROWS_AT_ONCE]) - lost
                new = total + part
                total, lost = new, (new - total) - part
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["part", "body"])

    def grouped(group: pa.Table) -> pa.Table:
        found = sorted(zip(group.column("part").to_pylist(), group.column("body").to_pylist()))
        total = sum(np.frombuffer(body).reshape(shape) for _, body in found)
        return pa.table({"part": pa.array([found[0][0]], pa.int32()), "body": pa.array([total.tobytes()], pa.binary())})

    parts = fit.mapInArrow(run, "part int, body binary")
    if large:
        parts = parts.groupBy((F.col("part") % GROUPS).alias("of")).applyInArrow(grouped, "part int, body binary")
    found = sorted((r.part, bytes(r.body)) for r in parts.collect())
    return sum((np.frombuffer(body).reshape(shape) for _, body in found), np.zeros(shape))


def fit(rows: DataFrame, components: int = 16) -> Whitener | None:
    """Fits to the distinct vectors of ``rows``, an array column x of longs, all of one length; None if there are none."""
    distinct = staged(rows.select("x").distinct(), "whitening-fit")
    head = distinct.select(F.size("x").alias("length")).groupBy("length").count().first()
    if head is None:
        return None
    length, n = head
    exact = distinct.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"))
    sums = [int(r.s) for r in sorted(exact.collect())]  # one row per dimension
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = np.array([s - int(m) * n for s, m in zip(sums, middle)], np.int64)
    shift, large = rest / n, n > VECTORS_DIRECT

    def centre(block: np.ndarray) -> np.ndarray:
        return (block - middle) - shift

    def product(vectors: np.ndarray) -> np.ndarray:
        def work(block: np.ndarray) -> np.ndarray:
            own = centre(block)
            return own.T @ (own @ vectors)

        return _summed(distinct, length, vectors.shape, work, large) / n

    trace = float(_summed(distinct, length, (), lambda block: (centre(block) ** 2).sum(), large)) / n
    model = Whitener(n, middle, rest, np.zeros(0), np.zeros((length, 0)), trace)
    if not trace > 0:
        return model
    values, axes = largest_pairs(product, length, components)
    kept = values > 1e-12 * trace
    model.values, model.axes = values[kept], axes[:, kept]

    def moments(block: np.ndarray) -> np.ndarray:
        out = model.whitened(block)
        return np.vstack([out.T @ out, out.sum(0)])

    count = int(kept.sum())
    both = _summed(distinct, length, (count + 1, count), moments, large) / n
    model.identity_error = float(np.abs(both[:-1] - np.outer(both[-1], both[-1]) - np.eye(count)).max())
    return model


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector: str = "vector", components: int = 16) -> DataFrame:
    """One row per vector and component: the id under its own name, component, n, deviation, whitened, explained, identity_error.

    ``vector`` is an array of longs; null marks rows that take no part.
    """
    spark = vectors.sparkSession
    usable = F.col(vector).isNotNull() & ~F.exists(vector, F.isnull)
    rows = staged(vectors.where(usable).select(F.col(id_col).alias("id"), F.col(vector).alias("x")), "whitening-rows")
    lengths = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if lengths is None:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    length = lengths.length
    rows = rows.where(F.size("x") == length)
    model = fit(rows, components)
    count = len(model.values)
    explained = model.values / model.trace if count else model.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = _rows(batch, length)
            for at in range(0, len(body) if count else 0, ROWS_AT_ONCE):
                block = body[at : at + ROWS_AT_ONCE]
                whole, far = model.whitened(block), model.deviations(block)
                size = len(block) * count
                ids = batch.column("id").take(pa.array(np.repeat(np.arange(at, at + len(block)), count)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(block))), pa.array(np.full(size, model.n)),
                     pa.array(np.repeat(far, count)), pa.array(whole.ravel()), pa.array(np.tile(explained, len(block))),
                     pa.array(np.full(size, model.identity_error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
