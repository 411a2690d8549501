"""Labelled rows for fitting: joined to their texts, held-out ids left out, bounded by a hash of the id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsflow.llm.base import crc_of_id
from opsflow.session import staged


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(body, label) of at most ``rows`` labelled documents, and of all if there are no more.

    Rows whose crc32(id) mod ``folds`` is ``held_out`` never take part. The sample keeps the
    ids of smallest hash, so reruns agree. Null labels are left out; an id that is labelled
    more than once counts as 1 if any of its labels is; of documents that share an id, the
    one whose text has the largest hash stands for it, so one id never brings many rows.
    """
    usable = labels.where(F.col(label).isin(0, 1) & (crc_of_id(F.col(id_col)) % folds != held_out))
    # A second hash, so that the sample does not follow the folds.
    labelled = usable.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label).cast("int")).alias("label")).withColumn(
        "place", F.pmod(F.xxhash64("id", F.lit(label)), F.lit(1 << 30)))
    # The share leaves few more than are wanted, so that no task sorts or sends more.
    share = 1.2 * rows / max(1, labelled.count()) + 1e-4
    drawn = labelled.where(F.col("place") < int(min(1.0, share) * (1 << 30))).orderBy("place", "id").limit(rows).select("id", "label")
    body = F.coalesce(text, F.lit(""))
    joined = docs.select(F.col(id_col).alias("id"), body.alias("body")).join(drawn, "id")
    one = joined.groupBy("id").agg(F.max(F.struct(F.xxhash64("body").alias("place"), "body")).alias("of"), F.max("label").alias("label"))
    return staged(one.select(F.col("of.body").alias("body"), "label"), "labelled")
