from pyspark.sql import functions as F

from helpers import rows
from opsflow.operators import joins
from opsflow.operators.aggregates import with_group_total


def test_full_outer_equals_the_built_in_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, x string")
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (None, 40)], "k int, y int")
    got = rows(joins.full_outer(left, right, ["k"]), "l_k", "l_x", "r_k", "r_y")
    l, r = left.toDF("l_k", "l_x"), right.toDF("r_k", "r_y")
    assert got == rows(l.join(r, l.l_k == r.r_k, "full_outer"))
    assert len(got) == 4 + 1 + 1 + 2


def test_lookup_keeps_or_drops_unknown_keys(spark):
    fact = spark.createDataFrame([(1, 5), (2, 6), (None, 7)], "k int, v int")
    dim = spark.createDataFrame([(1, "one")], "id int, name string")
    assert rows(joins.lookup(fact, dim, {"k": "id"})) == [(1, 5, "one")]
    assert len(rows(joins.lookup(fact, dim, {"k": "id"}, "left"))) == 3


def test_added_rows(spark):
    now = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, x string")
    then = spark.createDataFrame([(1, "z"), (None, "y")], "k int, x string")
    assert rows(joins.added_rows(now, then, ["k"])) == [(2, "b"), (None, "c")]


def test_duplicates_count_null_as_equal(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "b"), (5, "b")], "id int, c string")
    assert rows(joins.duplicate_rows(df, ["c"]), "id") == [(1,), (2,), (4,), (5,)]
    assert rows(joins.duplicate_keys(df, ["c"])) == [("b", 2), (None, 2)]


def test_outside_reference_passes_null(spark):
    df = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "c string")
    allowed = spark.createDataFrame([("a",)], "ok string")
    assert rows(joins.outside_reference(df, "c", allowed, "ok")) == [("x", 2)]


def test_group_total_of_a_null_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "g string, v int")
    assert rows(with_group_total(df, ["g"], F.col("v"), "t")) == [("a", 1, 3), ("a", 2, 3), (None, 5, 5)]
