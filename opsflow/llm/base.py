"""Small parts that several operators share."""

from __future__ import annotations

import posixpath
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word and line rules: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name (case is ignored, as in Spark)."""
    names = {t.lower() for t in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_of_id(doc_id: Column) -> Column:
    """CRC-32 of an id's decimal text, which deals labelled rows out; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def numbered(rows: DataFrame, name: str, *order: str | Column) -> DataFrame:
    """``rows`` with a long that is unique and ascends with ``order``, which must tell all rows apart; store it before using it twice."""
    return rows.orderBy(*order).withColumn(name, F.monotonically_increasing_id())
