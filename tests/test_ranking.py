"""Ranks at scale against plain windows, with one group or value holding most rows."""

import random

import pytest
from pyspark.sql import Window, functions as F

from helpers import plan, rows
from opsflow.operators import ranking


@pytest.fixture(scope="module")
def skewed(spark):
    draw = random.Random(7)
    data = []
    for i in range(3000):
        group = "hot" if i % 3 else draw.choice(["a", "b", None])
        score = draw.choice([50.0, 50.0, 50.0, None, draw.randint(0, 400) / 10])
        data.append((i, group, score))
    # Enough input partitions and no coalescing, so that the hot group does span pieces.
    return spark.createDataFrame(data, "id int, grp string, score double").repartition(6).cache()


@pytest.fixture(autouse=True)
def many_pieces(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def order():
    return [F.col("score").desc_nulls_first(), F.col("id")]


def test_hot_group_is_cut(skewed):
    pieces = ranking.cut_into_pieces(skewed, ["grp"], order())
    assert pieces.where("grp = 'hot'").select("_piece").distinct().count() > 3


def test_carry_has_at_most_one_row_per_piece(skewed):
    pieces = ranking.cut_into_pieces(skewed, ["grp"], order())
    carry = ranking.carried_rows(pieces, ["grp"])
    assert carry.groupBy("_piece").count().where("count > 1").isEmpty()


def test_row_number(skewed):
    window = Window.partitionBy("grp").orderBy(*order())
    got = ranking.row_number_at_scale(skewed, ["grp"], order(), "n")
    assert rows(got, "id", "n") == rows(skewed.withColumn("n", F.row_number().over(window)), "id", "n")


def test_rank_with_runs_across_pieces(skewed):
    window = Window.partitionBy("grp").orderBy(F.col("score").desc_nulls_first())
    got = ranking.rank_at_scale(skewed, ["grp"], "score", [F.col("id")], "n")
    assert rows(got, "id", "n") == rows(skewed.withColumn("n", F.rank().over(window)), "id", "n")
    assert got.columns == [*skewed.columns, "n"]


@pytest.mark.parametrize("count", [0, 1, 3, 5, 8, 3000])
def test_ntile(spark, skewed, count):
    some = skewed.where(F.col("id") < count)
    window = Window.partitionBy().orderBy(*order())
    got = ranking.ntile_at_scale(some, 4, order(), "n")
    assert rows(got, "id", "n") == rows(some.withColumn("n", F.ntile(4).over(window)), "id", "n")


def test_running_sum(skewed):
    window = Window.partitionBy("grp").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    got = ranking.running_sum_at_scale(skewed, ["grp"], [F.col("id")], "id", "total")
    assert rows(got, "id", "total") == rows(skewed.withColumn("total", F.sum("id").over(window)), "id", "total")


def test_top_k_is_cut_before_the_shuffle(skewed):
    top = ranking.top_k_per_group(skewed, ["grp"], order(), 2)
    assert top.groupBy("grp").count().where("count > 2").isEmpty()
    text = plan(top)
    assert "WindowGroupLimit" in text and "Partial" in text
