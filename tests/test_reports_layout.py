import os
from datetime import datetime
from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import D, by_key, plan, rows, ts
from opsflow.context import RunContext
from opsflow.operators import flatten, intervals, layout, masking, sketches
from opsflow.plans import reports
from opsflow.schemas import DELIVERY_LOG
from opsflow.session import job_scope, scale_settings, shared_dir, staged
from opsflow.sources.logs import delivery_manifest

RUN = RunContext.at(datetime(2024, 1, 31, 7))
SNAPSHOT = (
    "snapshot_date date, warehouse_name string, category string, sku_id int, quantity_on_hand decimal(18,4),"
    " unit_cost decimal(18,4), reorder_point int"
)


@pytest.fixture(scope="module")
def tables(spark):
    day, week = RUN.as_of, datetime(2024, 1, 28).date()
    snapshot = [
        (day, "W", "A", 1, D(5), D(2), 10),
        (day, "W", "A", 1, D(20), D(2), 10),
        (day, "W", "B", 2, D(100), D(3), 10),
        (week, "W", "A", 9, D(1), D(1), 10),
    ]
    card = [("old", 1.0, 1.0, 1.0, 99.0, "PREFERRED", day), ("b", 1.0, 1.0, 1.0, 80.0, "APPROVED", week), ("a", 1.0, 1.0, 1.0, None, "AT RISK", week)]
    return {
        "inventory_snapshot": spark.createDataFrame(snapshot, SNAPSHOT),
        "supplier_scorecard_weekly": spark.createDataFrame(
            card,
            "supplier_name string, on_time_delivery_pct double, fill_rate_pct double, defect_rate_pct double,"
            " composite_score double, supplier_status string, week_ending date",
        ),
    }


def test_inventory_summary(spark, tables):
    got = reports.execute(spark, reports.CATALOGUE[0], tables, RUN)
    assert [tuple(r) for r in got.collect()] == [("W", "B", 1, 100.0, 300.0, 0), ("W", "A", 1, 25.0, 50.0, 1)]


def test_scorecard_extract_takes_the_last_sunday(spark, tables):
    got = reports.execute(spark, reports.CATALOGUE[1], tables, RUN)
    assert [r["supplier_name"] for r in got.collect()] == ["a", "b"]


def test_parameters_are_bound_not_pasted(spark, tables):
    evil = reports.Report("x", "SELECT :p AS p FROM {inventory_snapshot}", {"p": "'; DROP TABLE t; --"})
    assert reports.execute(spark, evil, tables, RUN).first()["p"] == "'; DROP TABLE t; --"


def test_catalogue_run(spark, tables, tmp_path):
    root, log = str(tmp_path / "out"), str(tmp_path / "log")
    catalogue = [
        reports.CATALOGUE[0],
        reports.Report("Broken One", "SELECT nothing FROM {inventory_snapshot}", recipients=("x@example.com",)),
        reports.Report("Empty One", lambda t, p: t["inventory_snapshot"].where("false"), recipients=("y@example.com",)),
    ]
    outcome = reports.run_catalogue(spark, tables, RUN, root, log, catalogue)
    assert outcome == {"Daily Inventory Summary": "SUCCESS", "Broken One": "FAILURE", "Empty One": "NO_DATA"}
    assert os.path.isdir(f"{root}/report=daily_inventory_summary/run_date=2024-01-31")
    assert not os.path.isdir(f"{root}/report=empty_one/run_date=2024-01-31")
    manifest = delivery_manifest(spark.read.schema(DELIVERY_LOG).parquet(log))
    assert rows(manifest, "report_name", "status", "row_count", "recipient") == [
        ("Broken One", "FAILURE", 0, "x@example.com"),
        ("Daily Inventory Summary", "SUCCESS", 2, "operations@example.com"),
        ("Daily Inventory Summary", "SUCCESS", 2, "procurement@example.com"),
        ("Empty One", "NO_DATA", 0, "y@example.com"),
    ]
    with pytest.raises(Exception):
        reports.run_report(spark, catalogue[1], tables, RUN, root, log)


LINES = [
    ("full", '[{"sku_id":"A","quantity":2.5,"unit_price":1.5},{"sku_id":7,"quantity":3}]'),
    ("empty", "[]"),
    ("null", None),
    ("broken", "[{"),
]
FLAT = [("full", "7", D(3), None), ("full", "A", D(3), 1.5)]


def test_flatten(spark):
    orders = spark.createDataFrame(LINES, "order_id string, line_items_json string")
    assert rows(flatten.flatten_lines(orders)) == FLAT


def test_flatten_object_of_lines(spark):
    orders = spark.createDataFrame([("o", '{"x":{"sku_id":"A","quantity":1},"y":{"sku_id":"B"}}')], "order_id string, line_items_json string")
    assert rows(flatten.flatten_lines(orders)) == [("o", "A", D(1), None), ("o", "B", None, None)]


def test_a_rerun_without_rows_keeps_the_stored_report(spark, tables, tmp_path):
    root, log = str(tmp_path / "out"), str(tmp_path / "log")
    first = reports.run_report(spark, reports.CATALOGUE[0], tables, RUN, root, log)
    stored = rows(spark.read.parquet(reports.output_path(root, reports.CATALOGUE[0], RUN)))
    empty = {**tables, "inventory_snapshot": tables["inventory_snapshot"].where("false")}
    assert (first, reports.run_report(spark, reports.CATALOGUE[0], empty, RUN, root, log)) == ("SUCCESS", "NO_DATA")
    assert rows(spark.read.parquet(reports.output_path(root, reports.CATALOGUE[0], RUN))) == stored != []


def test_governed_view_follows_the_session_role(spark, tmp_path):
    spark.createDataFrame([("a@b@c.com", 1), (None, 2), ("plain", 3)], "email string, id int").write.parquet(str(tmp_path / "v"))
    masking.declare_role(spark)
    masking.create_email_mask(spark, "opsflow_mask", {"DATA_ADMIN", "O'Hara"})
    masking.governed_view(spark, "opsflow_governed", f"parquet.`{tmp_path}/v`", ["email", "id"], {"email": "opsflow_mask"})
    hidden, clear = [("****@c.com", 1), ("plain", 3), (None, 2)], [("a@b@c.com", 1), ("plain", 3), (None, 2)]
    sorted_hidden, sorted_clear = sorted(hidden, key=repr), sorted(clear, key=repr)
    assert rows(spark.table("opsflow_governed")) == sorted_hidden  # no role yet
    for role, wanted in (("GUEST", sorted_hidden), ("DATA_ADMIN", sorted_clear), ("O'Hara", sorted_clear), ("' OR true --", sorted_hidden)):
        masking.set_role(spark, role)
        assert rows(spark.sql("SELECT * FROM opsflow_governed")) == wanted
    masking.set_role(spark, "GUEST")
    # A filter on the column sees the mask too.
    assert spark.sql("SELECT * FROM opsflow_governed WHERE email LIKE 'a@%'").isEmpty()
    spark.catalog.dropTempView("opsflow_governed")


def test_masking_by_role(spark):
    df = spark.createDataFrame([("a@b@c.com", 1), (None, 2), ("plain", 3)], "email string, id int")
    policy = {"email": masking.email_policy({"DATA_ADMIN"})}
    assert rows(masking.masked(df, policy, "GUEST")) == [("****@c.com", 1), ("plain", 3), (None, 2)]
    assert rows(masking.masked(df, policy, "DATA_ADMIN")) == rows(df)
    masking.masked_view(df, policy, "GUEST", "opsflow_masked")
    assert spark.table("opsflow_masked").where("id = 1").first()["email"] == "****@c.com"


@pytest.fixture(scope="module")
def stock(spark):
    return spark.range(20_000).select(
        F.expr("date_add(date'2024-01-01', cast(id % 50 as int))").alias("d"),
        # Two thirds of the rows in one warehouse.
        F.when(F.col("id") % 3 > 0, "HOT").otherwise(F.concat(F.lit("W"), (F.col("id") % 7).cast("string"))).alias("w"),
        "id",
    )


def test_clustered_files_follow_each_other(spark, stock, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stock.repartition(8).write.parquet(str(tmp_path / "loose"))
        layout.write_clustered(stock, str(tmp_path / "tight"), ["d", "w"], spread_by=["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    loose = layout.files_in_order(spark.read.parquet(str(tmp_path / "loose")), ["d", "w", "id"]).first()
    tight = layout.files_in_order(spark.read.parquet(str(tmp_path / "tight")), ["d", "w", "id"]).first()
    assert (loose.file_count, loose.in_order) == (8, False)
    assert tight.file_count > 4 and tight.in_order
    assert layout.files_in_order(stock.where("false"), ["d"]).first().in_order


def test_one_value_is_cut_over_files(spark, stock, tmp_path):
    layout.write_clustered(stock, str(tmp_path / "t"), ["w"], spread_by=["id"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.write_clustered(stock, str(tmp_path / "t2"), ["w"], spread_by=["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = layout.file_ranges(spark.read.parquet(str(tmp_path / "t2")), ["w"])
    assert files.where("low.w = 'HOT' and high.w = 'HOT'").count() >= 3


def test_overlap_by_hand(spark):
    spans = spark.createDataFrame([("a", 1, 5), ("b", 3, 8), ("c", 5, 6), ("d", 9, 9), ("e", 9, 9), ("f", None, None)], "name string, low int, high int")
    got = {r["name"]: r["depth"] for r in intervals.with_overlap(spans, "low", "high").collect()}
    assert got == {"a": 1, "b": 2, "c": 3, "d": 2, "e": 2, "f": 1}


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 6)), min_size=1, max_size=20))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_overlap_equals_all_pairs(spark, spans):
    numbered = [(i, low, low + length) for i, (low, length) in enumerate(spans)]
    got = {r.i: r.depth for r in intervals.with_overlap(spark.createDataFrame(numbered, "i int, low int, high int"), "low", "high").collect()}
    assert got == {i: sum(a <= low <= b for _, a, b in numbered) for i, low, _ in numbered}


def test_bucketed_tables_join_and_group_without_a_shuffle(spark, stock, tmp_path):
    names = ["opsflow_left", "opsflow_right"]
    for name in names:
        layout.write_bucketed(stock.select("id", "w"), name, 4, ["id"], path=str(tmp_path / name))
    try:
        joined = layout.join_bucketed(spark.table(names[0]), spark.table(names[1]).withColumnRenamed("w", "v"), ["id"])
        grouped = joined.groupBy("id", "w").agg(F.count("v").alias("n"))
        for df in (joined, grouped):
            assert "Exchange" not in plan(df) and "SortMergeJoin" in plan(df)
        assert grouped.count() == 20_000
    finally:
        for name in names:
            spark.sql(f"DROP TABLE {name}")


def test_buckets_follow_the_rows(spark):
    some, none = spark.range(20_000), spark.range(0)
    assert layout.buckets_for(some, none) == layout.buckets_for(none, none) == 8
    assert layout.buckets_for(some, some, bucket_rows=1000) == 64
    assert layout.buckets_for(some.union(some), some.union(some), bucket_rows=1000) == 128
    assert layout.buckets_for(some, bucket_rows=9000, least=1) == 4


def test_sketches_merge_over_any_window(spark):
    rows_in = spark.range(60_000).select(
        (F.col("id") % 4).alias("g"), (F.col("id") % 6).alias("month"), (F.col("id") % 24_000).alias("order_id"),
    ).union(spark.createDataFrame([(9, 1, None), (8, 1, 5), (8, 2, 5)], "g long, month long, order_id long"))
    stored = sketches.distinct_sketches(rows_in, ["g", "month"], "order_id")
    for months in ([1], [1, 2, 3], [0, 1, 2, 3, 4, 5]):
        inside = rows_in.where(F.col("month").isin(months))
        exact = by_key(inside.groupBy("g").agg(F.count_distinct("order_id").alias("n")), "g", "n")
        got = by_key(sketches.merged_counts(stored.where(F.col("month").isin(months)), ["g"], "n"), "g", "n")
        assert got.keys() == exact.keys()
        assert all(abs(got[g] - exact[g]) <= 4 * sketches.STANDARD_ERROR * exact[g] for g in exact)
    assert max(map(len, by_key(stored, "g", "sketch").values())) < 6000
    checked = spark.createDataFrame([(104, 100), (110, 100), (0, 0)], "estimate long, exact long")
    assert [r[0] for r in checked.select(sketches.within("estimate", "exact")).collect()] == [True, False, True]


def test_shared_dir_must_be_named(spark):
    context = SimpleNamespace(master="local[2]", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context))


def test_a_job_scope_drops_what_it_stored(spark):
    with job_scope(spark) as folder:
        with job_scope(spark) as inner:
            assert inner.startswith(folder) and staged(spark.range(5), "five").count() == 5
            assert os.path.isdir(inner.removeprefix("file:"))
        assert not os.path.isdir(inner.removeprefix("file:"))
        assert staged(spark.range(3), "three").count() == 3
    assert not os.path.isdir(folder.removeprefix("file:"))


def test_scale_settings():
    small = scale_settings(1 << 30, 64)
    assert small["spark.sql.shuffle.partitions"] == "64"
    assert scale_settings(10 << 40, 4000)["spark.sql.shuffle.partitions"] == str((10 << 40) // (128 << 20))


def test_timestamps_have_no_zone(spark):
    assert ts("2024-01-01") == spark.createDataFrame([(ts("2024-01-01"),)], "t timestamp_ntz").first()[0]
