from datetime import date

import pytest
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import D, by_key, plan, rows, ts
from opsflow.operators import changes as chg
from opsflow.plans import close, close_script, summary
from opsflow.schemas import MONTHLY_CLOSE

MOVES = (
    "id int, transaction_date timestamp_ntz, warehouse_id string, sku_id string, category string,"
    " transaction_type string, quantity decimal(18,4), unit_cost decimal(18,4)"
)
few = settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
movement = st.tuples(
    st.integers(1, 3),
    st.sampled_from("AB"),
    st.sampled_from(["RECEIPT", "SHIPMENT", "OTHER"]),
    st.one_of(st.none(), st.integers(0, 50)),
    st.one_of(st.none(), st.integers(1, 9)),
)


def moves(spark, content):
    return spark.createDataFrame(
        [
            (i, ts(f"2024-01-0{d} 10:00:00"), "W", sku, "C", kind, None if q is None else D(q), None if c is None else D(c))
            for i, (d, sku, kind, q, c) in content.items()
        ],
        MOVES,
    )


def test_summary(spark):
    df = moves(spark, {1: (1, "A", "RECEIPT", 10, 2), 2: (1, "A", "SHIPMENT", 4, 4), 3: (1, "A", "OTHER", 99, 99), 4: (2, "A", "RECEIPT", 1, None)})
    got = by_key(summary.daily_summary(df), "snapshot_day", "total_received", "total_shipped", "net_movement", "avg_unit_cost")
    assert got == {date(2024, 1, 1): (D(10), D(4), D(6), 3.0), date(2024, 1, 2): (D(1), D(0), D(1), None)}


@few
@given(st.lists(movement, max_size=12), st.integers(0, 12))
def test_refresh_equals_recompute(spark, content, cut):
    numbered = dict(enumerate(content))
    first = {i: m for i, m in numbered.items() if i < cut}
    rest = {i: m for i, m in numbered.items() if i >= cut}
    parts = summary.refresh(summary.summary_state(moves(spark, first)), summary.summary_state(moves(spark, rest)))
    assert rows(summary.summary_view(parts)) == rows(summary.daily_summary(moves(spark, numbered)))


@few
@given(st.dictionaries(st.integers(0, 8), movement, max_size=8), st.dictionaries(st.integers(0, 8), movement, max_size=8))
def test_changes_move_the_summary(spark, old, new):
    before, after = moves(spark, old), moves(spark, new)
    delta = summary.state_of_changes(chg.changes(before, after, "id"))
    moved = summary.refresh(summary.summary_state(before), delta)
    assert rows(summary.summary_view(moved)) == rows(summary.daily_summary(after))


def test_stored_summary_takes_each_batch_once(spark, tmp_path):
    path = str(tmp_path / "s")
    content = {i: (1 + i % 3, "A", "RECEIPT", i, 1) for i in range(6)}
    before = moves(spark, content)
    summary.fold(path, before, F.lit(0), "day")
    files = {d.name: sorted(d.iterdir()) for d in (tmp_path / "s").glob("period=*")}
    # Day 1 loses all its rows, day 3 gains one.
    after = moves(spark, {**{i: m for i, m in content.items() if m[0] != 1}, 9: (3, "B", "SHIPMENT", 4, 2)})
    for _ in range(2):
        summary.fold(path, chg.changes(before, after, "id"), F.lit(1), "day")
    assert rows(summary.summary_view(summary.read_state(spark, path))) == rows(summary.daily_summary(after))
    # Only the days that changed were written again.
    kept = [name for name in files if sorted((tmp_path / "s" / name).iterdir()) == files[name]]
    assert len(files) == 3 and len(kept) == 1


def test_recent_days_newest_first(spark):
    df = moves(spark, {i: (i, "A", "RECEIPT", 1, 1) for i in (1, 2, 3)})
    got = summary.recent_summary(summary.daily_summary(df), date(2024, 4, 2))
    assert [r["snapshot_day"].day for r in got.collect()] == [3, 2]


def test_close_twice_gives_the_same_table(spark, tmp_path):
    staging, table = str(tmp_path / "s"), str(tmp_path / "c")
    data = [
        (1, ts("2024-01-31 23:59:59.999999"), "W", "A", "C", "X", D(2), D(3)),
        (2, ts("2024-02-01 00:00:00"), "W", "A", "C", "X", D(5), D(1)),
        (3, ts("2024-01-01 00:00:00"), "W", "A", "C", "X", D(1), D(1)),
        (4, ts("2024-01-05 00:00:00"), "W", "B", "C", "X", None, D(1)),
    ]
    df = spark.createDataFrame(data, MOVES)

    def run(year, month, stamp):
        return close.monthly_close(spark, df, year, month, staging, table, ts(stamp))

    assert run(2024, 1, "2024-02-01") == "Monthly close for 2024-01 completed successfully."
    run(2024, 2, "2024-03-01")
    january = [("A", "W", "2024-01", D("3.0000"), D("7.0000")), ("B", "W", "2024-01", None, None)]
    february = [("A", "W", "2024-02", D("5.0000"), D("5.0000"))]

    def content():
        return spark.read.schema(MONTHLY_CLOSE).parquet(table)

    assert rows(content().drop("updated_at"), *MONTHLY_CLOSE.names[:5]) == sorted(january + february, key=repr)
    run(2024, 1, "2024-02-05")
    assert rows(content().drop("updated_at"), *MONTHLY_CLOSE.names[:5]) == sorted(january + february, key=repr)
    stamps = by_key(content().where("sku_id = 'A'"), "close_period", "updated_at")
    assert stamps == {"2024-01": ts("2024-02-05"), "2024-02": ts("2024-03-01")}


def test_a_month_that_has_lost_its_movements_keeps_its_last_close(spark, tmp_path):
    staging, table = str(tmp_path / "s"), str(tmp_path / "c")
    df = spark.createDataFrame([(1, ts("2024-01-05 00:00:00"), "W", "A", "C", "X", D(2), D(3))], MOVES)
    close.monthly_close(spark, df, 2024, 1, staging, table, ts("2024-02-01"))
    close.monthly_close(spark, df.where("false"), 2024, 1, staging, table, ts("2024-02-09"))
    got = spark.read.schema(MONTHLY_CLOSE).parquet(table)
    assert rows(got, "sku_id", "net_qty", "updated_at") == [("A", D(2), ts("2024-02-01"))]
    close.monthly_close(spark, df.where("false"), 2024, 3, staging, table, ts("2024-04-01"))
    assert spark.read.schema(MONTHLY_CLOSE).parquet(table).count() == 1


def test_close_script_equals_the_close(spark, tmp_path):
    data = [
        (1, ts("2024-01-31 23:59:59.999999"), "W", "A", "C", "X", D(2), D(3)),
        (2, ts("2024-02-01 00:00:00"), "W", "A", "C", "X", D(5), D(1)),
        (3, ts("2024-01-05 00:00:00"), "W", "B", "C", "X", None, D(1)),
        (4, ts("2024-01-05 00:00:00"), "W'; DROP", "B", "C", "X", D(1), D(1)),
    ]
    names = [f"opsflow_script_{n}" for n in ("close", "staging", "merged")]
    close_script.create_close_tables(spark, *names, str(tmp_path / "script"))
    spark.createDataFrame(data, MOVES).createOrReplaceTempView("opsflow_script_moves")

    def both(content, year, month, stamp):
        df = spark.createDataFrame(content, MOVES)
        df.createOrReplaceTempView("opsflow_script_moves")
        messages = {
            close_script.run_close_script(spark, "opsflow_script_moves", *names, year, month, ts(stamp)),
            close.monthly_close(spark, df, year, month, str(tmp_path / "s"), str(tmp_path / "c"), ts(stamp)),
        }
        assert messages == {f"Monthly close for {year}-{month:02d} completed successfully."}
        wanted = spark.read.schema(MONTHLY_CLOSE).parquet(str(tmp_path / "c"))
        assert rows(spark.table(names[0]).select(*MONTHLY_CLOSE.names)) == rows(wanted.select(*MONTHLY_CLOSE.names)) != []

    try:
        both(data[:2], 2024, 1, "2024-02-01")
        both(data, 2024, 2, "2024-03-01")
        both(data, 2024, 1, "2024-03-02")
        both(data, 2024, 7, "2024-08-01")
        with pytest.raises(RuntimeError, match="Monthly close for 2024-01 failed"):
            close_script.run_close_script(spark, "opsflow_no_such_view", *names, 2024, 1, ts("2024-04-01"))
    finally:
        spark.catalog.dropTempView("opsflow_script_moves")
        for name in names:
            spark.sql(f"DROP TABLE {name}")


def test_month_range_reaches_the_scan(spark, tmp_path):
    moves(spark, {1: (1, "A", "RECEIPT", 1, 1)}).write.parquet(str(tmp_path / "m"))
    text = plan(close.close_rows(spark.read.parquet(str(tmp_path / "m")), 2024, 1))
    assert "GreaterThanOrEqual(transaction_date" in text and "LessThan(transaction_date" in text


def test_rows_of_a_closed_month_that_vanish_are_kept(spark):
    table = spark.createDataFrame([("A", "W", "2024-01", D(1), D(1), ts("2024-02-01"))], MONTHLY_CLOSE)
    source = spark.createDataFrame([("B", "W", "2024-01", D(2), D(2))], "sku_id string, warehouse_id string, close_period string, net_qty decimal(38,4), total_value decimal(38,4)")
    got = close.upsert_close(table, source, ts("2024-03-01"))
    assert by_key(got, "sku_id", "updated_at") == {"A": ts("2024-02-01"), "B": ts("2024-03-01")}
    assert got.where(F.col("net_qty").isNull()).isEmpty()
