from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import D, rows
from opsflow.context import RunContext, month_bounds, months_back, period_label, quarter_start, resolve_date_token
from opsflow.functions import dates, numeric, text


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def values(spark, schema, data, column):
    return [r[0] for r in spark.createDataFrame([(v,) for v in data], schema).select(column).collect()]


def test_half_up_reads_six_decimals(spark):
    got = values(spark, "x double", [1.005, -0.001, 2.5, None], numeric.round_half_up(F.col("x"), 2))
    assert got == [1.01, 0.0, 2.5, None]
    assert str(got[1]) == "0.0"


def test_half_even_on_half_cents(spark):
    got = values(spark, "x decimal(36,8)", [D("0.125"), D("0.135"), D("0.145")], numeric.round_half_even(F.col("x"), 2, "decimal(18,2)"))
    assert got == [D("0.12"), D("0.14"), D("0.14")]


def test_ratios_guard_zero_and_null(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (1, None), (None, 4)], "a int, b int")
    assert [r[0] for r in df.select(numeric.ratio(F.col("a"), F.col("b"))).collect()] == [0.25, None, None, None]
    assert [r[0] for r in df.select(numeric.pct_change(F.col("a"), F.col("b"))).collect()] == [-75.0, None, None, None]


def test_floor_at_zero_keeps_null(spark):
    assert values(spark, "x double", [-3.0, 3.0, None], numeric.floor_at_zero(F.col("x"))) == [0.0, 3.0, None]


def test_lenient_double(spark):
    assert values(spark, "x string", ["12", "12x", " 1.5 ", None], numeric.lenient_double(F.col("x"))) == [12.0, None, 1.5, None]


def test_title_case(spark):
    got = values(spark, "x string", ["  o'neil foo-bar baz3qux ", "ABC def\t", "", None], text.title_case(F.col("x")))
    assert got == ["O'Neil Foo-Bar Baz3Qux", "Abc Def", "", None]


def test_map_code_falls_back_to_the_raw_value(spark):
    got = values(spark, "x string", [" ship ", "rcpt", "receipt", "foo ", None], text.map_code(F.col("x"), {"SHIP": "SHIPMENT", "RCPT": "RECEIPT"}))
    assert got == ["SHIPMENT", "RECEIPT", "receipt", "foo ", None]


def test_row_hash_counts_null_as_empty(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "", 1), ("a", "b", 1)], "x string, y string, z int")
    first, second, third = [r[0] for r in df.select(text.row_hash([F.col(c) for c in "xyz"])).collect()]
    assert first == second != third
    assert len(first) == 32


def test_row_hash_is_the_same_for_midnight_in_any_batch(spark):
    stamp = dates.naive(datetime(2024, 1, 1))
    alone = one(spark, text.row_hash([stamp]))
    mixed = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 1, 3, 30),)], "t timestamp_ntz")
    assert alone == mixed.select(text.row_hash([F.col("t")])).first()[0]


def test_mask_mailbox(spark):
    got = values(spark, "x string", ["a@b.com", "a@b@c.com", "none", None], text.mask_mailbox(F.col("x")))
    assert got == ["****@b.com", "****@c.com", "none", None]


def test_regex_matches_at_start_only(spark):
    assert values(spark, "x string", ["AB1", "xAB", None], text.starts_with_match(F.col("x"), "AB|CD")) == [True, False, None]


def test_parse_timestamp_reads_each_value_on_its_own(spark):
    got = values(
        spark,
        "x string",
        ["2025-01-01", "2025-01-02 03:00", "01/31/2025", "20250203", "nonsense", None],
        dates.parse_timestamp(F.col("x")),
    )
    assert got == [
        datetime(2025, 1, 1),
        datetime(2025, 1, 2, 3),
        datetime(2025, 1, 31),
        datetime(2025, 2, 3),
        None,
        None,
    ]


def test_age_hours(spark):
    assert one(spark, dates.age_hours(dates.naive(datetime(2024, 1, 1, 22, 30)), datetime(2024, 1, 2))) == 1.5


def test_month_filter_takes_the_last_instant(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 31, 23, 59, 59, 999999),), (datetime(2024, 2, 1),), (datetime(2024, 1, 1),)], "t timestamp_ntz"
    )
    assert df.where(dates.in_month(F.col("t"), 2024, 1)).count() == 2


def test_periods():
    assert period_label(2025, 8) == "2025-08"
    assert month_bounds(2024, 12) == (datetime(2024, 12, 1), datetime(2025, 1, 1))
    assert months_back(date(2024, 3, 31), 1) == date(2024, 2, 29)
    assert months_back(date(2024, 1, 15), 14) == date(2022, 11, 15)
    assert months_back(date(2024, 12, 31), 12) == date(2023, 12, 31)
    assert quarter_start(date(2024, 5, 20)) == date(2024, 4, 1)


@pytest.mark.parametrize(
    "as_of, wanted",
    [(date(2024, 1, 28), "2024-01-28"), (date(2024, 1, 29), "2024-01-28"), (date(2024, 2, 3), "2024-01-28")],
)
def test_last_sunday(as_of, wanted):
    assert resolve_date_token("last_sunday", as_of) == wanted


def test_other_tokens():
    assert resolve_date_token("today", date(2024, 1, 29)) == "2024-01-29"
    assert resolve_date_token("2020-02-02", date(2024, 1, 29)) == "2020-02-02"
    assert RunContext.at(datetime(2024, 1, 29, 8)).as_of == date(2024, 1, 29)


def test_iso_week(spark):
    got = spark.createDataFrame([(datetime(2024, 12, 30),)], "t timestamp_ntz").select(F.year("t"), F.weekofyear("t"))
    assert rows(got) == [(2024, 1)]
