"""Removal of lines that many documents share, by levelled sorted runs of line hashes.

A run is a stored table of (line hash, number of documents), one row per hash, sorted by
hash. Each batch of documents counts its own lines, is merge-anti-joined with the runs of
lines already known to be frequent, and adds what is left as a run on level 0. When a
level holds ``fanout`` runs they are compacted into one: counts are summed, lines that
reach the threshold move to a run of frequent lines, the others to a run one level up.
So a line is rewritten once per level, not once per batch.

Everything is DataFrame expressions. Line hashes are 128 bits (two 64-bit hashes).
A line's key is the line without white space at both ends, A-Z in lower case.

Defined cases: a null or empty text is one empty line; keys shorter than ``min_chars``
are never counted or dropped; every row of a batch is a document, repeated ids and
texts included; a document counts once for a line however often it holds it; an empty
batch adds an empty run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsflow.llm.base import BLANKS, ascii_lower, free_name
from opsflow.session import work_path

RUN = "key_a long, key_b long, docs long"
KEY = ["key_a", "key_b"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _hashes(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("key_a"), F.xxhash64(F.lit(1), key).alias("key_b")]


def batch_counts(docs: DataFrame, text: str = "text", min_chars: int = 1, batch: Column | None = None) -> DataFrame:
    """Documents per line hash (and per ``batch``, if given)."""
    keys = F.array_distinct(F.transform(lines_of(F.col(text)), line_key))
    part = [] if batch is None else [batch.alias("batch")]
    lines = docs.select(*part, F.explode(keys).alias("key")).where(F.length("key") >= min_chars)
    return lines.select(*(["batch"] if part else []), *_hashes("key")).groupBy(
        *(["batch"] if part else []), *KEY
    ).agg(F.count("*").alias("docs"))


class LineRuns:
    """The runs of one corpus, below a fresh folder of the shared store."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 4):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.folder = work_path(spark, "line-runs")
        self.levels: list[list[str]] = [[]]
        self.frequent_runs: list[str] = []
        self._written = 0

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], RUN)
        return self.spark.read.schema(RUN).parquet(*paths)

    def _write(self, run: DataFrame) -> str:
        self._written += 1
        path = f"{self.folder}/run-{self._written}"
        run.sortWithinPartitions(*KEY).write.partitionBy("frequent").parquet(path)
        return path

    def _store(self, run: DataFrame, level: int) -> None:
        """Writes a run, its frequent lines apart, in one pass."""
        path = self._write(run.withColumn("frequent", F.col("docs") >= self.min_docs))
        files = self.spark.read.schema(RUN + ", frequent boolean").parquet(path)
        for part, target in ((True, self.frequent_runs), (False, self._level(level))):
            if files.where(F.col("frequent") == part).limit(1).count():
                target.append(f"{path}/frequent={str(part).lower()}")

    def _level(self, level: int) -> list[str]:
        while len(self.levels) <= level:
            self.levels.append([])
        return self.levels[level]

    def add(self, counts: DataFrame) -> None:
        """Adds one batch, given as its ``batch_counts``."""
        known = self._read(self.frequent_runs).select(*KEY).hint("merge")
        self._store(counts.select(*KEY, "docs").join(known, KEY, "left_anti"), 0)
        level = 0
        while len(self._level(level)) >= self.fanout:
            self._compact([level], level + 1)
            level += 1

    def _compact(self, levels: list[int], into: int) -> None:
        paths = [path for level in levels for path in self._level(level)]
        known = self._read(self.frequent_runs).select(*KEY).hint("merge")
        merged = self._read(paths).join(known, KEY, "left_anti").groupBy(*KEY).agg(F.sum("docs").alias("docs"))
        for level in levels:
            self.levels[level] = []
        self._store(merged, into)

    def frequent(self) -> DataFrame:
        """Hashes of the lines found in at least ``min_docs`` documents of all batches so far."""
        if sum(map(len, self.levels)) > 1:
            self._compact(list(range(len(self.levels))), len(self.levels) - 1)
        return self._read(self.frequent_runs).select(*KEY).distinct()


def frequent_lines(docs: DataFrame, batch_of: str, text: str = "text", min_docs: int = 10, min_chars: int = 1,
                   batches: int = 4, fanout: int = 2) -> DataFrame:
    """Hashes of the frequent lines of a whole table, worked in batch by batch.

    The lines are counted by batch in one pass over the texts; each batch then only
    reads its own counts. ``batch_of`` names the column whose hash deals out the batches.
    """
    spark = docs.sparkSession
    path = work_path(spark, "line-batches")
    batch = F.pmod(F.xxhash64(batch_of), F.lit(batches)).cast("int")
    batch_counts(docs, text, min_chars, batch).write.partitionBy("batch").parquet(path)
    counted = spark.read.schema("batch int, " + RUN).parquet(path)
    runs = LineRuns(spark, min_docs, fanout)
    for b in range(batches):
        runs.add(counted.where(F.col("batch") == b))
    return runs.frequent()


def drop_lines(docs: DataFrame, frequent: DataFrame, text: str = "text", min_chars: int = 1) -> DataFrame:
    """``docs`` with the struct column ``lines``: total and dropped lines, and the kept text.

    ``lines`` has n_lines, n_dropped and kept. If docs already has a column of that name,
    the new one gets underscores at its end. Only hashes and positions are shuffled to
    find the lines to drop; the texts are shuffled once, to meet their positions. Equal
    texts share one list of positions, so repeated rows and ids need no row number.
    """
    name = free_name(docs.columns, "lines")
    texts = docs.select(F.col(text).alias("body")).where(F.col("body").isNotNull())
    lines = texts.select(
        F.xxhash64("body").alias("body_a"), F.xxhash64(F.lit(1), "body").alias("body_b"),
        F.posexplode(lines_of(F.col("body"))).alias("pos", "line"),
    ).select("body_a", "body_b", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    hits = (
        lines.select("body_a", "body_b", "pos", *_hashes("key"))
        .join(frequent, KEY, "left_semi")
        .groupBy("body_a", "body_b").agg(F.array_sort(F.collect_set("pos")).alias("hits"))
    )
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    body = F.col("row").getField(text)
    joined = packed.join(
        hits, (F.xxhash64(body) == F.col("body_a")) & (F.xxhash64(F.lit(1), body) == F.col("body_b")), "left"
    ).select("row", lines_of(body).alias("all"), F.coalesce("hits", F.array().cast("array<int>")).alias("hits"))
    # The stretches between dropped lines; the one-element array binds the lines once for all of them.
    starts = F.concat(F.array(F.lit(0)), F.transform("hits", lambda p: p + 1))
    stops = F.concat(F.col("hits"), F.array(F.size("all")))
    stretches = F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
    kept = F.transform(
        F.array("all"), lambda ls: F.flatten(F.transform("stretches", lambda g: F.slice(ls, g["a"] + 1, g["n"])))
    )
    return joined.withColumn("stretches", stretches).select(
        "row.*",
        F.struct(
            F.size("all").cast("long").alias("n_lines"), F.size("hits").cast("long").alias("n_dropped"),
            F.array_join(kept[0], "\n").alias("kept"),
        ).alias(name),
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1,
                batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with the result of dropping every line whose key stands in at least ``min_docs`` documents."""
    found = frequent_lines(docs, id_col, text, min_docs, min_chars, batches, fanout)
    return drop_lines(docs, found, text, min_chars)


def without_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", chars: str | None = "n_chars",
                  min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with the lines dropped from its text and, if it has the column ``chars``, the new length; null texts stay null."""
    found = dedup_lines(docs, id_col, text, min_docs, min_chars)
    result = F.col(found.columns[-1])
    kept = F.when(F.col(text).isNotNull(), result["kept"])
    new = {text: kept}
    if chars in docs.columns:
        new[chars] = F.coalesce(F.length(kept).cast(docs.schema[chars].dataType), F.col(chars))
    return found.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
