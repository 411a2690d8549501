"""The corpus pipeline: each stage calls one operator of the library on all rows its predecessor kept.

A stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``:

1. toxicity: documents scored 0.3 or more go.
2. line_dedup: lines found in at least 10 documents go from every text; a document stays even if no line does.
3. simhash: one document of each class of near-duplicates stays, the one with the smallest id.
4. mix: each document as often as the mix by source takes it, which may be never.
5. packing: the pieces of sequences of 2048 ids.

Rows with null ids or texts, empty and repeated ones pass by the rules of each operator;
an empty table stays empty. SQL cannot express scores, fingerprints and ids, so there is
no ORACLE_SQL; the tests compare every stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsflow.llm import line_dedup, mixing, packing, simhash, toxicity
from opsflow.llm.base import table
from opsflow.llm.queries import tokenizer_file
from opsflow.session import staged

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), folds=4, held_out=2)
    return docs.where(toxicity.score(F.col("text"), model) < 0.3)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_lines(docs, min_docs=10, min_chars=1)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, words=4, radius=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, weights=(1, 2, 3), max_copies=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), capacity=2048, end_id=1)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_duplicates),
    ("mix", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
