import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import D, day, plan, rows, ts
from opsflow import registry
from opsflow.operators import changes as chg, versions
from opsflow.plans import etl, summary
from opsflow.registry import QUERIES
from opsflow.schemas import STAGED_INVENTORY, conform
from opsflow.session import job_scope
from opsflow.sources.views import view
from opsflow.streaming import cdc, feed, load, summary as stream_summary

SF = "/root/testdata/sf0.001"
RUN, OLD = ts("2024-01-31"), ts("2024-01-01")


@pytest.fixture(scope="module")
def movements(spark):
    sources = etl.Sources(view(spark, SF, "fx_movements"), view(spark, SF, "fx_sku_master"), view(spark, SF, "fx_warehouses"))
    rows = etl.transform(etl.extract(sources, OLD), RUN)
    return rows.toDF(*[c.lower() for c in rows.columns]).cache()


def test_summary_stream_equals_batch(spark, movements, tmp_path):
    movements.repartition(5).write.parquet(str(tmp_path / "in"))
    source = load.file_stream(spark, str(tmp_path / "in"), movements.schema, files_per_batch=2)
    out = str(tmp_path / "out")
    stream_summary.run_summary_stream(source, out, str(tmp_path / "cp")).awaitTermination()
    state = summary.read_state(spark, out)
    assert rows(summary.summary_view(state)) == rows(summary.daily_summary(movements))
    # Three batches have left one row a group, in one partition a month.
    assert state.count() == state.select(*summary.KEYS).distinct().count()
    assert [d.name for d in (tmp_path / "out").glob("period=*")] == ["period=2024-01"]
    # Late rows in new files are counted.
    movements.limit(20).write.mode("append").parquet(str(tmp_path / "in"))
    stream_summary.run_summary_stream(source, out, str(tmp_path / "cp")).awaitTermination()
    assert rows(summary.summary_view(summary.read_state(spark, out))) == rows(summary.daily_summary(movements.union(movements.limit(20))))


def test_summary_refuses_the_batch_numbers_of_another_checkpoint(spark, movements, tmp_path):
    movements.write.parquet(str(tmp_path / "in"))
    source = load.file_stream(spark, str(tmp_path / "in"), movements.schema)
    stream_summary.run_summary_stream(source, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    before = rows(summary.read_state(spark, str(tmp_path / "out")))
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        stream_summary.run_summary_stream(source, str(tmp_path / "out"), str(tmp_path / "fresh")).awaitTermination()
    assert rows(summary.read_state(spark, str(tmp_path / "out"))) == before


CHANGES = (
    "warehouse_id string, sku_id string, category string, transaction_type string, quantity decimal(18,4), unit_cost decimal(18,4),"
    " transaction_date date, dml_action string, is_update boolean, commit_id long"
)


def moved(commit, action, on, quantity, update=False, kind="RECEIPT", sku="A"):
    return ("W", sku, "C", kind, quantity, D(2), on, action, update, commit)


def test_summary_follows_deletes_and_updates_across_months(spark, tmp_path):
    january, march = day("2024-01-05"), day("2024-03-05")
    batches = [
        [moved(1, "INSERT", january, D(5)), moved(1, "INSERT", march, D(7)), moved(1, "INSERT", january, D(2), sku="B")],
        [moved(2, "DELETE", january, D(5), True), moved(2, "INSERT", march, D(6), True)],
        [moved(3, "DELETE", january, D(2), sku="B"), moved(3, "INSERT", march, D(1), kind="SHIPMENT")],
        [moved(4, "INSERT", None, D(9), kind="SHIPMENT"), moved(4, "INSERT", march, None)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, CHANGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = load.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], CHANGES).schema, files_per_batch=1)
    out = str(tmp_path / "out")
    columns = ["snapshot_day", "sku_id", "total_received", "total_shipped"]
    for checkpoint in ("first", "second"):  # the second one reads everything again
        stream_summary.run_summary_stream(source, out, str(tmp_path / checkpoint), "commit_id").awaitTermination()
        got = rows(summary.summary_view(summary.read_state(spark, out)), *columns)
        assert got == sorted([(march, "A", D(13), D(1)), (None, "A", D(0), D(9))], key=repr)
    assert sorted(d.name for d in (tmp_path / "out").glob("period=*")) == ["period=2024-01", "period=2024-03", "period=none"]


def test_a_half_swapped_fold_is_completed_by_its_repeat(spark, tmp_path):
    """A batch of two months of which one partition was swapped in before the driver was lost."""
    out = str(tmp_path / "out")
    both = spark.createDataFrame([moved(1, "INSERT", day("2024-01-05"), D(5)), moved(1, "INSERT", day("2024-02-05"), D(7))], CHANGES)
    summary.fold(out, both, F.col("commit_id"))
    shutil.rmtree(tmp_path / "out" / "period=2024-02")
    for _ in range(2):
        summary.fold(out, both, F.col("commit_id"))
        assert rows(summary.read_state(spark, out), "total_received") == [(D(5),), (D(7),)]
    summary.fold(out, both.where("false"), F.col("commit_id"))
    # An older batch that comes late again does not turn the mark back.
    summary.fold(out, both.withColumn("commit_id", F.lit(9)), F.col("commit_id"))
    summary.fold(out, both, F.col("commit_id"))
    summary.fold(out, both.withColumn("commit_id", F.lit(9)), F.col("commit_id"))
    assert rows(summary.read_state(spark, out), "total_received") == [(D(10),), (D(14),)]


def test_a_range_opens_only_its_months(spark, tmp_path):
    out = str(tmp_path / "out")
    days = [moved(1, "INSERT", day(f"2024-{month:02d}-10"), D(month)) for month in range(1, 9)]
    summary.fold(out, spark.createDataFrame(days, CHANGES), F.col("commit_id"))
    got = summary.read_state(spark, out, since=day("2024-06-15"))
    assert rows(got, "total_received") == [(D(7),), (D(8),)]
    text = plan(got)
    assert "PartitionFilters: [isnotnull(period" in text and ">= 2024-06" in text
    for file in (tmp_path / "out" / "period=2024-05").glob("*.parquet"):
        file.write_bytes(b"not opened")
    assert rows(summary.read_state(spark, out, since=day("2024-06-15")), "total_received") == [(D(7),), (D(8),)]
    with pytest.raises(Exception, match="2024-05"):
        summary.read_state(spark, out).collect()


def test_windowed_summary_holds_open_days_too(spark, movements, tmp_path):
    movements.repartition(3).write.parquet(str(tmp_path / "in"))
    source = load.file_stream(spark, str(tmp_path / "in"), movements.schema)
    windows = stream_summary.windowed_summary(source, "1 day")
    out = str(tmp_path / "out")
    stream_summary.run_windowed_stream(windows, out, str(tmp_path / "cp")).awaitTermination()
    got = stream_summary.read_windowed(spark, out, windows.schema)
    columns = ["snapshot_day", "warehouse_id", "sku_id", "category", "total_received", "total_shipped"]
    assert rows(got, *columns) == rows(summary.daily_summary(movements), *columns)


def fact_table(spark, path, buckets=4, sequence=None):
    rows_schema = spark.createDataFrame([], "id int, a string, b int, last_updated_ts timestamp_ntz").schema
    return cdc.FactTable(str(path), rows_schema, "id", ["b"], buckets=buckets, sequence=sequence)


FEED = "id int, a string, b int, dml_action string, is_update boolean"


def test_batches_merge_like_the_operator(spark, tmp_path):
    table = fact_table(spark, tmp_path / "fact")
    first = spark.createDataFrame([(i, "x", i, "INSERT", False) for i in range(20)], FEED)
    cdc.merge_batch(first, table, OLD)
    second = spark.createDataFrame(
        [(i, "y", 100 + i, "INSERT", True) for i in range(5)]
        + [(i, "x", i, "DELETE", False) for i in range(10, 15)]
        + [(50, "z", 50, "INSERT", False)],
        FEED,
    )
    cdc.merge_batch(second, table, RUN)
    target = first.select("id", "a", "b").withColumn("last_updated_ts", F.lit(OLD).cast("timestamp_ntz"))
    assert rows(table.read(spark)) == rows(chg.merge_changes(target, second, "id", ["b"], RUN))
    # Plain rows in plain partitions: no version and no mark of removed rows.
    assert set(spark.read.parquet(table.path).columns) == {"id", "a", "b", "last_updated_ts", "bucket"}


def test_every_batch_may_come_twice(spark, tmp_path):
    table = fact_table(spark, tmp_path / "fact")
    target = spark.createDataFrame([], "id int, a string, b int, last_updated_ts timestamp_ntz")
    batches = [
        [(i, "x", i, "INSERT", False) for i in range(6)],
        [(0, "y", 50, "INSERT", True), (1, "y", 1, "DELETE", False), (9, "n", 9, "INSERT", False)],
        [(1, "z", 51, "INSERT", False), (9, "n", 9, "DELETE", False), (2, "w", 52, "INSERT", True)],
        [(0, "q", 60, "INSERT", True), (2, "w", 52, "DELETE", False), (7, "v", 7, "INSERT", True)],
    ]
    for n, batch in enumerate(batches):
        feed, stamp = spark.createDataFrame(batch, FEED), ts(f"2024-02-0{n + 1}")
        for _ in range(2):
            cdc.merge_batch(feed, table, stamp)
        target = spark.createDataFrame(rows(chg.merge_changes(target, feed, "id", ["b"], stamp)), target.schema)
        assert rows(table.read(spark)) == rows(target)


def files_of(path):
    return {f.name for f in path.rglob("*.parquet")}


def test_untouched_partitions_are_neither_read_nor_rewritten(spark, tmp_path):
    table = fact_table(spark, tmp_path / "fact", buckets=8)
    cdc.merge_batch(spark.createDataFrame([(i, "x", i, "INSERT", False) for i in range(40)], FEED), table, OLD)
    before = {d.name: files_of(d) for d in (tmp_path / "fact").glob("bucket=*")}
    cdc.merge_batch(spark.createDataFrame([(3, "y", 70, "INSERT", True)], FEED), table, RUN)
    after = {d.name: files_of(d) for d in (tmp_path / "fact").glob("bucket=*")}
    assert len(before) == 8 and sum(before[d] != after[d] for d in before) == 1
    assert table.read(spark).count() == 40
    assert "PartitionFilters: [bucket" in plan(table.stored(spark).where(F.col("bucket").isin([1, 2])))


def test_a_partition_that_loses_all_rows_is_emptied(spark, tmp_path):
    table = fact_table(spark, tmp_path / "fact", buckets=1)
    cdc.merge_batch(spark.createDataFrame([(1, "x", 1, "INSERT", False)], FEED), table, OLD)
    cdc.merge_batch(spark.createDataFrame([(1, "x", 1, "DELETE", False)], FEED), table, RUN)
    assert table.read(spark).isEmpty()
    cdc.merge_batch(spark.createDataFrame([(1, "w", 2, "INSERT", False)], FEED), table, RUN)
    assert rows(table.read(spark), "id", "a") == [(1, "w")]


def test_a_half_merged_batch_is_completed_by_its_repeat(spark, tmp_path):
    table = fact_table(spark, tmp_path / "fact")
    cdc.merge_batch(spark.createDataFrame([(i, "x", i, "INSERT", False) for i in range(8)], FEED), table, OLD)
    feed = spark.createDataFrame([(i, "y", 70, "INSERT", True) for i in range(8)], FEED)
    cdc.merge_batch(feed.where("id < 3"), table, OLD)  # what a lost driver may have left
    cdc.merge_batch(feed, table, RUN)
    assert rows(table.read(spark)) == [(i, "x", 70, RUN) for i in range(8)]


def test_cdc_stream(spark, tmp_path):
    table = fact_table(spark, tmp_path / "fact")
    feed = spark.createDataFrame([(i, "x", i, "INSERT", False) for i in range(30)], FEED)
    feed.repartition(3, "id").write.parquet(str(tmp_path / "in"))
    source = load.file_stream(spark, str(tmp_path / "in"), feed.schema, files_per_batch=1)
    for _ in range(2):  # the second start finds nothing new
        cdc.run_cdc_stream(source, table, str(tmp_path / "cp"), RUN).awaitTermination()
    assert table.read(spark).count() == 30
    spark.createDataFrame([(3, "x", 3, "DELETE", False)], FEED).write.mode("append").parquet(str(tmp_path / "in"))
    cdc.run_cdc_stream(source, table, str(tmp_path / "cp"), RUN).awaitTermination()
    assert table.read(spark).count() == 29


def test_a_fresh_checkpoint_neither_hides_new_rows_nor_brings_old_ones_back(spark, tmp_path):
    """Batches 0 to 2 insert, update and delete; then batch 0 of a fresh checkpoint holds them all again, and a new key."""
    table = fact_table(spark, tmp_path / "fact", sequence="n")
    folder, schema = str(tmp_path / "in"), FEED + ", n long"
    for n, batch in enumerate([[(1, "x", 1, "INSERT", False), (2, "x", 2, "INSERT", False)], [(1, "x", 9, "INSERT", True)], [(2, "x", 2, "DELETE", False)]]):
        spark.createDataFrame([(*r, n) for r in batch], schema).coalesce(1).write.mode("append").parquet(folder)
    source = load.file_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)
    cdc.run_cdc_stream(source, table, str(tmp_path / "first"), OLD).awaitTermination()
    assert rows(table.read(spark), "id", "b") == [(1, 9)] and table.mark(spark) == 2
    spark.createDataFrame([(4, "new", 4, "INSERT", False, 3)], schema).coalesce(1).write.mode("append").parquet(folder)
    cdc.run_cdc_stream(source, table, str(tmp_path / "second"), RUN).awaitTermination()
    assert rows(table.read(spark)) == [(1, "x", 9, OLD), (4, "new", 4, RUN)]


LOG = "k int, j string, v int, commit_ts timestamp_ntz, commit_id long, action string"


def log_of(spark, *entries):
    return spark.createDataFrame([(k, j, v, ts("2024-01-01"), n, a) for k, j, v, n, a in entries], LOG)


def test_feed_between_two_commits(spark):
    log = log_of(
        spark, (1, "a", 5, 1, "INSERT"), (2, "a", 5, 2, "INSERT"), (3, "a", 5, 3, "INSERT"), (4, None, 5, 4, "INSERT"), (6, "a", 1, 5, "DELETE"),
        (1, "a", 6, 10, "UPDATE"), (1, "a", 7, 11, "UPDATE"), (2, "a", 5, 12, "DELETE"), (3, "a", 9, 13, "UPDATE"), (3, "a", 5, 14, "UPDATE"),
        (4, None, None, 15, "UPDATE"), (5, "a", 1, 16, "INSERT"), (6, "a", 2, 17, "INSERT"), (7, "a", 1, 18, "INSERT"), (7, "a", 1, 19, "DELETE"),
        (1, "a", 99, 20, "UPDATE"),
    )
    got = rows(feed.feed_between(log, ["k", "j"], 5, 19))
    assert got == sorted([
        (1, "a", 5, "DELETE", True), (1, "a", 7, "INSERT", True), (2, "a", 5, "DELETE", False), (4, None, 5, "DELETE", True),
        (4, None, None, "INSERT", True), (5, "a", 1, "INSERT", False), (6, "a", 2, "INSERT", False),
    ], key=repr)
    assert rows(feed.feed_between(log, ["k", "j"], 5, 19, append_only=True)) == [(5, "a", 1, "INSERT", False), (6, "a", 2, "INSERT", False)]
    assert rows(feed.feed_between(log, ["k", "j"], 20, 30)) == []


def test_feed_equals_the_difference_of_two_states(spark):
    log = view(spark, SF, "fx_commit_log")
    keys = ["sku_id", "channel"]
    for after, upto in ((-1, 400), (400, 401), (300, 999)):
        states = [versions.latest_state(log.where(F.col("commit_id") <= n), keys).drop("commit_ts", "commit_id") for n in (after, upto)]
        keyed = [s.withColumn("key", F.concat_ws("|", *keys)) for s in states]
        wanted = rows(chg.changes(*keyed, "key").drop("key"))
        assert rows(feed.feed_between(log, keys, after, upto)) == wanted != []


def test_the_slice_is_pushed_to_the_scan(spark, tmp_path):
    view(spark, SF, "fx_commit_log").write.parquet(str(tmp_path / "log"))
    text = plan(feed.feed_between(spark.read.parquet(str(tmp_path / "log")), ["sku_id", "channel"], 500, 600))
    assert "GreaterThan(commit_id,500), LessThanOrEqual(commit_id,600)" in text and "LessThanOrEqual(commit_id,500)" in text
    assert "LeftSemi" in text


def test_the_offset_moves_with_the_consumer_alone(spark, tmp_path):
    log, offsets = log_of(spark, (1, "a", 5, 1, "INSERT"), (2, "a", 5, 2, "INSERT")), str(tmp_path / "offsets")
    got = []

    def take(changes, upto):
        got.append((upto, len(rows(changes))))

    def fail(changes, upto):
        raise KeyError("no")

    with pytest.raises(KeyError):
        feed.consume(log, ["k"], offsets, "one", fail, RUN)
    assert feed.offset_of(spark, offsets, "one") == feed.NOTHING_SEEN
    assert feed.consume(log.where("commit_id < 2"), ["k"], offsets, "one", take, RUN) == 1
    assert feed.consume(log, ["k"], offsets, "one", take, RUN) == 2
    assert feed.consume(log, ["k"], offsets, "one", fail, RUN) is None
    assert feed.consume(log, ["k"], offsets, "two", take, RUN) == 2
    assert got == [(1, 1), (2, 1), (2, 2)]


def test_load_stream_equals_batch(spark, tmp_path):
    raw = view(spark, SF, "fx_movements")
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    batch = etl.Sources(raw, view(spark, SF, "fx_sku_master"), view(spark, SF, "fx_warehouses"))
    live = etl.Sources(load.file_stream(spark, str(tmp_path / "in"), raw.schema, 1), batch.skus, batch.warehouses)
    load.run_load_stream(live, str(tmp_path / "out"), str(tmp_path / "cp"), RUN, OLD).awaitTermination()
    got = conform(spark.read.schema(STAGED_INVENTORY).parquet(str(tmp_path / "out")), STAGED_INVENTORY)
    assert rows(got) == rows(etl.transform(etl.extract(batch, OLD), RUN))
    assert got.where(F.col("QUANTITY") < D(0)).isEmpty()


@pytest.mark.parametrize("name", ["daily_summary_stream", "daily_summary_windowed", "etl_stream"])
def test_event_stream_reads_a_table_of_part_files(spark, tmp_path, name):
    for table in ("nation", "supplier", "part", "customer", "orders", "lineitem"):
        shutil.copy(f"{SF}/{table}.parquet", tmp_path)
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    with job_scope(spark):
        wanted = rows(QUERIES[name](spark, SF))
        assert wanted and rows(QUERIES[name](spark, str(tmp_path))) == wanted


def test_a_commit_of_many_files_is_one_micro_batch(spark, tmp_path):
    on = day("2024-01-05")
    commits = [
        spark.createDataFrame([moved(0, "INSERT", on, D(i), sku=f"S{i}") for i in range(40)], CHANGES).repartition(4),
        spark.createDataFrame([moved(1, "DELETE", on, D(i), sku=f"S{i}") for i in range(0, 40, 2)], CHANGES).repartition(3),
    ]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run(checkpoint, files=None):
        source = load.file_stream(spark, folder, commits[0].schema, files)
        stream_summary.run_summary_stream(source, out, str(tmp_path / checkpoint), "commit_id").awaitTermination()

    registry._drain(commits, folder, lambda: run("first"))
    assert len(spark.read.parquet(folder).inputFiles()) == 7
    assert sorted(f.name for f in (tmp_path / "first" / "commits").glob("[0-9]*")) == ["0", "1"]
    wanted = sorted((f"S{i}", D(i)) for i in range(1, 40, 2))
    assert rows(summary.read_state(spark, out), "sku_id", "total_received") == sorted(wanted, key=repr)
    run("second", registry._files_of_a_fourth(spark, folder))
    assert len([*(tmp_path / "second" / "commits").glob("[0-9]*")]) == 7
    assert rows(summary.read_state(spark, out), "sku_id", "total_received") == sorted(wanted, key=repr)


def test_a_large_commit_is_written_by_many_tasks(spark, tmp_path):
    asked = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    feed = spark.range(40_000).select(F.col("id").alias("transaction_id"), F.sha2(F.col("id").cast("string"), 256).alias("body"))
    before = spark.conf.get(asked)
    spark.conf.set(asked, "100k")
    try:
        registry._store_by_commit(feed, str(tmp_path / "changes"), 2)
    finally:
        spark.conf.set(asked, before)
    for commit in (1, 2):
        assert len([*(tmp_path / "changes" / f"commit={commit}").glob("*.parquet")]) > 3
    commits = registry._commits_of(spark, str(tmp_path / "changes"), 2, feed.schema)
    assert rows(commits[0].union(commits[1])) == rows(feed) and all(c.count() > 15_000 for c in commits)
