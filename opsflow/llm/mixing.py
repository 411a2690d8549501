"""Mixing sources to target weights by hash thresholds.

Every document has a fixed pseudo-random rank (a hash of its id). A source gives its
documents ``copies`` whole times, and once more those whose rank lies below the source's
threshold, so that a larger budget always takes a superset. The threshold is found
without sorting: words are summed by source and by the leading bits of the rank, the
bucket in which the budget ends is looked up, and only that bucket is cut finer by the
next bits, until it holds a single rank.

Defined cases: a null or empty text has size 0; a null source is a source of its own, last
in order; a null id ranks as an empty text; rows of equal id in one source are taken or
left together; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsflow.llm.base import word_count
from opsflow.session import staged

RANK_BITS = 60
LEVEL_BITS = 10


def rank(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 of the id's text; a null id counts as an empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, RANK_BITS // 4), 16, 10).cast("long")


def fill_level(sources: DataFrame, max_copies: int) -> float:
    """Words a unit of weight gets when no source exceeds ``max_copies`` times its size.

    A source that would exceed its cap stops there and the rest is shared again by weight.
    One aggregate per round over the table of sources; the capped set only grows.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap = max_copies * F.col("source_size")
    level, held = 0.0, -1
    while True:
        capped = F.lit(held >= 0) & (cap.cast("double") < F.col("weight") * F.lit(level))
        row = sources.agg(
            F.sum(F.when(capped, cap).otherwise(0)).alias("caps"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("weights"),
            F.count_if(capped).alias("held"),
        ).first()
        if row.held == held or not row.weights:
            return level
        level, held = float(total - row.caps) / float(row.weights), row.held


def targets(sized: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """One row per source: its size, weight, and target."""
    # One row per source stands in this window, whatever the number of documents.
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    by_source = staged(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place.cast("int") + 1)),
        "mix-sources",
    )
    level = fill_level(by_source, max_copies)
    return by_source.withColumn(
        "target", F.least((max_copies * F.col("source_size")).cast("double"), F.col("weight") * F.lit(level))
    )


def thresholds(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """The mix of ``sized`` (source, size, rank): one row per source.

    Columns: source, source_size, target, copies (whole times each document is taken), cut
    (rank below which documents are taken once more; null: all of them) and cut_in (whether
    those at the cut are too, which is so if that brings the source nearer to its target).
    Documents of equal rank are taken or left together. An empty table has no rows.
    """
    plan = targets(sized, weights, max_copies)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = staged(
        plan.select(
            "source", "source_size", "target", whole.cast("long").alias("copies"),
            (F.col("target") - whole * F.col("source_size")).alias("rest"),
            F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"),
            F.lit(0).cast("long").alias("at_cut"), F.lit(True).alias("ends"), F.lit(False).alias("single"),
        ),
        "mix-plan",
    )
    for bits in range(LEVEL_BITS, RANK_BITS + 1, LEVEL_BITS):
        plan = staged(_refined(sized, plan, bits), "mix-plan")
        if not plan.where("ends and not single").limit(1).count():
            break
    cut = F.when(F.col("copies") >= max_copies, -1).when(F.col("ends"), F.col("prefix"))
    cut_in = 2 * F.col("before") + F.col("at_cut") <= 2.0 * F.col("rest")
    return staged(plan.select("source", "source_size", "target", "copies", cut.alias("cut"), cut_in.alias("cut_in")), "mix-cuts")


def _refined(sized: DataFrame, plan: DataFrame, bits: int) -> DataFrame:
    """``plan`` with each open boundary bucket replaced by the one, ``bits`` deep, in which the budget ends."""
    shift = RANK_BITS - bits
    open_ = plan.where("ends and not single")
    inside = sized.alias("s").join(
        open_.select(F.col("source").alias("of"), "prefix"),
        F.col("s.source").eqNullSafe(F.col("of")) & (F.shiftright("rank", shift + LEVEL_BITS) == F.col("prefix")),
    )
    sums = inside.groupBy("s.source", F.shiftright("rank", shift).alias("bucket")).agg(
        F.sum("size").alias("words"), F.min("rank").alias("low"), F.max("rank").alias("high")
    )
    # At most 2 ** LEVEL_BITS rows of a source.
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    crossing = (
        sums.withColumn("upto", upto)
        .join(open_.select(F.col("source").alias("of"), "rest", F.col("before").alias("start")),
              F.col("source").eqNullSafe(F.col("of")))
        .where(F.col("start") + F.col("upto") > F.col("rest"))
        .groupBy("source")
        .agg(F.min(F.struct("bucket", (F.col("start") + F.col("upto") - F.col("words")).alias("before"),
                            "words", "low", "high")).alias("at"))
    )
    found = plan.alias("p").join(crossing.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
    moved, single = F.col("ends") & ~F.col("p.single"), F.col("at.low") == F.col("at.high")
    return found.select(
        "p.source", "source_size", "target", "copies", "rest",
        F.when(moved, F.when(single, F.col("at.low")).otherwise(F.col("at.bucket"))).otherwise(F.col("prefix")).alias("prefix"),
        F.when(moved, F.col("at.before")).otherwise(F.col("p.before")).alias("before"),
        F.when(moved, F.col("at.words")).otherwise(F.col("at_cut")).alias("at_cut"),
        F.when(moved, F.col("at").isNotNull()).otherwise(F.col("ends")).alias("ends"),
        F.when(moved, F.coalesce(single, F.lit(False))).otherwise(F.col("p.single")).alias("single"),
    )


def with_copies(rows: DataFrame, plan: DataFrame, source: str, ranked: Column, name: str = "copies") -> DataFrame:
    """``rows`` with the number of times the mix takes each, by ``thresholds``.

    Only the table of one row per source is joined; nothing is sorted or grouped.
    """
    plan = plan.select(
        F.col("source").alias("mix_source"), "source_size", "target", F.col("copies").alias("mix_copies"), "cut", "cut_in"
    )
    plan = plan.select(F.struct("*").alias("mix"))
    once = F.coalesce((ranked < F.col("mix.cut")) | ((ranked == F.col("mix.cut")) & F.col("mix.cut_in")), F.lit(True))
    return rows.join(plan, rows[source].eqNullSafe(F.col("mix.mix_source")), "left").withColumn(
        name, F.col("mix.mix_copies") + once.cast("long")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
          weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its own columns."""
    sized = staged(
        docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"), rank(F.col(id_col)).alias("rank")),
        "mix-sizes",
    )
    plan = thresholds(sized, weights, max_copies)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source).alias("of"), rank(F.col(id_col)).alias("rank")
    )
    taken = with_copies(packed, plan, "of", F.col("rank"))
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
