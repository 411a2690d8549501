"""Token-id files: documents in id order, encoded and grammar-compressed shard by shard.

The format is a Parquet dataset with one row per shard, in the order (part, shard):

* part, shard: place of the shard; part n holds smaller ids than part n + 1
* n_tokens: ids of the shard
* doc_ids, doc_ends: the shard's documents in ascending order, and for each the number of
  the shard's ids up to its end
* grammar: the shard's ids as written by ``repair.Grammar.to_bytes``

Documents are range-partitioned and sorted by id, so a shard only holds neighbours and no
task holds more than one shard's ids at a time. A shard closes after ``shard_tokens`` ids,
at the end of a document. ``read_documents`` decodes all; ``read_tokens`` any stretch.

Defined cases: a null or empty text is the end id alone; null ids come first; documents of
equal id are ordered by a hash of their text; an empty table gives an empty dataset.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsflow.llm.repair import Grammar, compress
from opsflow.llm.tokens import encoder

#: What a row weighs beside its text when parts are sized.
ROW_BYTES = 512


def write_documents(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text",
                    shard_tokens: int = 1 << 20, part_bytes: int = 32 << 20) -> None:
    """Writes ``docs`` as token files below ``path``, which must not exist."""
    kind = dict(docs.dtypes)[id_col]
    arrow_kind = docs.select(id_col).schema
    # A row weighs something without text too, so that many short texts are cut into parts like few long ones.
    volume = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES)).first()[0] or 0
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text).alias("body"), F.xxhash64(text).alias("tie"))
    ordered = narrow.repartitionByRange(max(1, -(-volume // part_bytes)), "id", "tie").sortWithinPartitions("id", "tie")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        encode, part, shard = encoder(tokenizer), TaskContext.get().partitionId(), 0
        base, end = encode.tokenizer.get_vocab_size(), np.array([end_id], "<u4").tobytes()
        of = to_arrow_type(arrow_kind[0].dataType)
        ids, bodies, held = [], [], 0

        def closed() -> pa.RecordBatch:
            run = np.frombuffer(b"".join(bodies), "<u4")
            ends = np.cumsum([len(b) // 4 for b in bodies])
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(run)], pa.int64()),
                 pa.array([ids], pa.list_(of)), pa.array([ends.tolist()], pa.list_(pa.int64())),
                 pa.array([compress(run, max(base, end_id + 1)).to_bytes()], pa.binary())],
                ["part", "shard", "n_tokens", "doc_ids", "doc_ends", "grammar"],
            )

        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), encode.encode_all(t.as_py() for t in batch.column(1))):
                ids.append(doc_id)
                bodies.append(body + end)
                held += len(body) // 4 + 1
                if held >= shard_tokens:
                    yield closed()
                    ids, bodies, held, shard = [], [], 0, shard + 1
        if ids:
            yield closed()

    schema = f"part int, shard int, n_tokens long, doc_ids array<{kind}>, doc_ends array<long>, grammar binary"
    ordered.select("id", "body").mapInArrow(shards, schema).write.parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Each shard with ``first``, the number of ids before it: totals of parts, then of shards within one."""
    shards = spark.read.parquet(path).select("part", "shard", "n_tokens")
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # One row per part here, one part's shards below; neither holds documents.
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("part_first"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return shards.withColumn("inside", F.coalesce(inside, F.lit(0))).join(parts, "part").select(
        "part", "shard", "n_tokens", (F.col("part_first") + F.col("inside")).alias("first")
    )


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Every document of the files: its id, start (ids of all documents before it), n_tokens, ids (binary)."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    shards = files.drop("n_tokens").join(shard_starts(spark, path), ["part", "shard"])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = batch.slice(row, 1)
                ends = shard.column("doc_ends").flatten().to_numpy()
                starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                body = Grammar.from_bytes(shard.column("grammar")[0].as_py()).decode().tobytes()
                yield pa.RecordBatch.from_arrays(
                    [shard.column("doc_ids").flatten(), pa.array(starts + shard.column("first")[0].as_py()),
                     pa.array(ends - starts), pa.array([body[4 * a : 4 * b] for a, b in zip(starts, ends)], pa.binary())],
                    ["id", "start", "n_tokens", "ids"],
                )

    wanted = shards.select("doc_ids", "doc_ends", "grammar", "first")
    return wanted.mapInArrow(documents, f"id {kind}, start long, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def read_tokens(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """The ids from ``start`` to ``stop`` of the whole corpus; opens the shards that hold them and expands only those symbols."""
    shards = shard_starts(spark, path).where((F.col("first") < stop) & (F.col("first") + F.col("n_tokens") > start))
    rows = shards.join(spark.read.parquet(path).select("part", "shard", "grammar"), ["part", "shard"]).orderBy("first").collect()
    parts = [Grammar.from_bytes(bytes(r.grammar)).decode(max(0, start - r.first), stop - r.first) for r in rows]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
