"""One key holds a large share of the rows: results stay whole and AQE cuts the key's partition."""

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from opsflow.operators import joins
from opsflow.operators.aggregates import with_group_total
from opsflow.operators.layout import write_rebalanced
from opsflow.sources.tables import replace_partitions

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.fixture(autouse=True)
def small_limits(spark):
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the rows under one key, a tenth without a key."""
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id"))
    return spark.range(0, 60_000, 1, 8).select(key.cast("int").alias("k"), F.col("id").alias("v"), F.md5(F.col("id").cast("string")).alias("pad"))


def ran(df):
    """Final plan after a run that needs every column."""
    hashed = df.agg(F.bit_xor(F.xxhash64(*df.columns)).alias("h"))
    hashed.collect()
    return plan(hashed).split("Initial Plan")[0]


def test_full_outer(spark, hot):
    right = spark.range(0, 3000).select(F.col("id").cast("int").alias("k"), F.col("id").alias("w"))
    joined = joins.full_outer(hot, right, ["k"])
    assert "skew=true" in ran(joined)
    l, r = hot.toDF("l_k", "l_v", "l_pad"), right.toDF("r_k", "r_w")
    native = l.join(r, l.l_k == r.r_k, "full_outer")
    assert rows(joined.drop("l_pad")) == rows(native.drop("l_pad"))


def test_full_outer_with_the_hot_key_on_the_right(spark, hot):
    left = spark.range(100, 3000).select(F.col("id").cast("int").alias("k"), F.col("id").alias("w"))
    joined = joins.full_outer(left, hot, ["k"])
    assert "skew=true" in ran(joined)
    assert joined.count() == 2900 - 2900 // 2 + 2900 // 10 + 60_000


def test_lookup(spark, hot):
    dim = spark.range(0, 60_000).select(F.col("id").cast("int").alias("d"), F.md5(F.col("id").cast("string")).alias("name"))
    for how in ("inner", "left"):
        joined = joins.lookup(hot, dim, {"k": "d"}, how)
        assert "skew=true" in ran(joined)
        assert joined.count() == hot.where("k is not null").count() if how == "inner" else hot.count()


def test_duplicate_rows(spark, hot):
    found = joins.duplicate_rows(hot, ["k"])
    assert "skew=true" in ran(found)
    assert found.count() == hot.where("k = 7 or k is null").count()


def test_rewritten_partition_is_cut_over_tasks(spark, hot, tmp_path):
    few = hot.select(F.when(F.col("k") == 7, 1).otherwise(F.col("v") % 3 + 2).cast("int").alias("p"), "v", "pad")
    replace_partitions(few, str(tmp_path / "r"), ["p"])
    write_rebalanced(few, str(tmp_path / "w"), ["p"], ["v"])
    for name in ("r", "w"):
        files = [f for f in (tmp_path / name / "p=1").iterdir() if f.suffix == ".parquet"]
        assert len(files) > 3
        assert rows(spark.read.parquet(str(tmp_path / name)).select("p", "v")) == rows(few.select("p", "v"))


def test_group_total(spark, hot):
    totalled = with_group_total(hot, ["k"], F.lit(1), "n")
    assert "skew=true" in ran(totalled)
    assert totalled.where("k = 7").select("n").distinct().first()[0] == totalled.where("k = 7").count()
