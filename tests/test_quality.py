import pytest
from pyspark.sql import functions as F

from helpers import D, plan, rows, ts
from opsflow.operators import quality as dq

NOW = ts("2024-06-01 12:00:00")
PARCELS = "code string, bin string, grams int, zone string, scanned timestamp_ntz, fee decimal(10,2)"


@pytest.fixture(scope="module")
def parcels(spark):
    """Parcels of a small depot: one code used three times, two without a bin, weights and zones out of bounds."""
    data = [
        ("P-7", "B1", 12, "north", ts("2024-06-01 11:30:00"), D("4.20")),
        ("P-8", None, 900, "south", ts("2024-06-01 01:00:00"), D("7.75")),
        ("P-9", "B2", 30, "moon", ts("2024-05-31 23:00:00"), D("0.00")),
        ("P-9", None, 31, "north", ts("2024-05-30 12:00:00"), D("1.10")),
        ("P-9", "B3", 0, "east", ts("2024-05-29 12:00:00"), D("2.35")),
        ("Q-1", "B1", 45, "south", ts("2024-05-28 12:00:00"), D("3.00")),
        ("Q-2", "B2", 44, "east", ts("2024-05-27 12:00:00"), D("9.99")),
        ("Q-3", "B2", 43, "north", ts("2024-05-26 12:00:00"), D("6.40")),
    ]
    return spark.createDataFrame(data, PARCELS)


def parcel_rules():
    return [
        dq.row_count_threshold(2, 8),
        dq.is_unique("code"),
        dq.not_null("bin"),
        dq.not_null("zone", dq.MEDIUM),
        dq.in_range("grams", 1, 500),
        dq.in_range("fee", 0, 9.99, dq.LOW),
        dq.referential_integrity("zone", {"north", "south", "east"}, dq.MEDIUM),
        dq.matches_regex("code", "P"),
        dq.freshness("scanned", NOW, 1),
    ]


def test_suite(spark, parcels):
    report = dq.run_suite(parcels, "parcels", parcel_rules(), "scanned", NOW)
    got = [
        (r["rule_id"], r["severity"], r["status"], r["rows_failed"], r["failure_pct"], r["sample_failures"], r["message"])
        for r in report.results_frame(spark).collect()
    ]
    assert got == [
        ("row_count", "CRITICAL", "PASS", 0, 0.0, "[]", "Got 8 rows (expected 2–8)"),
        ("unique_code", "CRITICAL", "FAIL", 3, 37.5, "['P-9']", "3 duplicate row(s) on 'code'"),
        ("not_null_bin", "CRITICAL", "FAIL", 2, 25.0, "['2024-05-30 12:00:00', '2024-06-01 01:00:00']", "2 NULL(s) found"),
        ("not_null_zone", "MEDIUM", "PASS", 0, 0.0, "[]", "All values present"),
        ("range_grams", "HIGH", "FAIL", 2, 25.0, "['0', '900']", "2 value(s) outside [1, 500]"),
        ("range_fee", "LOW", "PASS", 0, 0.0, "[]", "All in range"),
        ("ref_int_zone", "MEDIUM", "FAIL", 1, 12.5, "['moon']", "1 unexpected value(s)"),
        ("regex_code", "MEDIUM", "FAIL", 3, 37.5, "['Q-3', 'Q-2', 'Q-1']", "3 value(s) fail pattern match"),
        ("freshness_scanned", "HIGH", "PASS", 0, 0.0, "[]", "Latest record: 2024-06-01 11:30 (0.5h ago)"),
    ]
    assert report.score == 44.4 and not report.overall_pass
    assert [r.rule_id for r in report.critical_failures] == ["unique_code", "not_null_bin"]
    assert [r.severity for r in report.failed] == ["CRITICAL", "CRITICAL", "HIGH", "MEDIUM", "MEDIUM"]
    with pytest.raises(ValueError, match=r"\['unique_code', 'not_null_bin'\]"):
        report.raise_on_critical()
    assert rows(report.summary_frame(spark)) == [(9, 4, 5, 2, 44.4, "FAIL", 8)]


def test_each_grouping_rule_scans_once(spark, parcels, tmp_path):
    parcels.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    kept = dq.failing_groups(stored, dq.is_unique("code"), "scanned").persist()
    assert kept.agg(F.sum("row_count")).first()[0] == 3
    sampled = dq.failing_samples(stored, [dq.is_unique("code")], [0], "scanned", {0: kept})
    assert "InMemoryTableScan" in plan(sampled) and [r["value"] for r in sampled.collect()] == ["P-9"]
    kept.unpersist()


def test_empty_table(spark, parcels):
    report = dq.run_suite(parcels.where("false"), "empty", parcel_rules(), "scanned", NOW)
    assert {r.failure_pct for r in report.results if r.rule_id != "row_count"} == {0.0}
    by_id = {r.rule_id: r for r in report.results}
    assert by_id["row_count"].status == dq.FAIL and by_id["row_count"].failure_pct == 100.0
    # No readable date is a warning under the short rule name.
    assert by_id["freshness"].status == dq.WARNING


def result(df, rule, key=None):
    return dq.run_suite(df, "t", [rule], key, NOW).results[0]


def test_missing_column_is_skipped_and_leaves_the_gate_open(spark, parcels):
    report = dq.run_suite(parcels, "t", [dq.not_null("nowhere"), dq.not_null("code")], None, NOW)
    assert [r.status for r in report.results] == [dq.SKIPPED, dq.PASS]
    assert "nowhere" in report.results[0].message
    report.raise_on_critical()
    with pytest.raises(ValueError):
        report.raise_on_critical(strict=True)


def test_nan_counts_as_null_in_floating_columns(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert result(df, dq.not_null("x")).rows_failed == 2
    assert result(df, dq.in_range("x", 0, 5)).rows_failed == 0


def test_two_nulls_break_uniqueness(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "x string")
    assert result(df, dq.is_unique("x")).rows_failed == 2


def test_range_passes_text_that_is_no_number(spark):
    df = spark.createDataFrame([("12x",), ("7",), (None,), ("0",), ("5",)], "x string")
    found = result(df, dq.in_range("x", 0, 5))
    assert (found.rows_failed, found.samples) == (1, ("7",))


def test_regex_must_match_at_the_start(spark):
    df = spark.createDataFrame([("AB",), ("xAB",), (None,)], "x string")
    found = result(df, dq.matches_regex("x", "AB"))
    assert (found.rows_failed, found.samples, found.failure_pct) == (1, ("xAB",), pytest.approx(100 / 3))


def test_empty_allowed_set_fails_every_value(spark):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    assert result(df, dq.referential_integrity("x", set())).rows_failed == 1


def test_reference_table(spark):
    df = spark.createDataFrame([("a", 1), ("z", 3), ("z", 2), ("y", 9), (None, 4)], "x string, id int")
    allowed = spark.createDataFrame([("a",), ("b",)], "code string")
    found = result(df, dq.referential_integrity("x", allowed, allowed_column="code"), "id")
    assert (found.rows_failed, found.samples) == (3, ("z", "y"))


def test_row_count_bounds(spark):
    df = spark.range(5)
    assert result(df, dq.row_count_threshold(1, 5)).status == dq.PASS
    assert result(df, dq.row_count_threshold(1, 4)).message == "Got 5 rows (expected 1–4)"


def test_freshness_of_text_dates(spark):
    df = spark.createDataFrame([("2024-05-30",), ("junk",)], "x string")
    found = result(df, dq.freshness("x", NOW))
    assert (found.status, found.message) == (dq.FAIL, "Latest record: 2024-05-30 00:00 (60.0h ago)")
    assert result(spark.createDataFrame([("junk",)], "x string"), dq.freshness("x", NOW)).status == dq.WARNING


def test_samples_keep_repeats_except_for_set_and_uniqueness_rules(spark):
    df = spark.createDataFrame([(i, 9 if i % 2 else 8, "bad") for i in range(20)], "id int, v int, c string")
    report = dq.run_suite(df, "t", [dq.in_range("v", 0, 5), dq.referential_integrity("c", {"ok"}), dq.is_unique("v")], "id", NOW)
    assert [r.samples for r in report.results] == [("8", "9", "8", "9", "8"), ("bad",), ("8", "9")]


def test_own_rules(spark, parcels):
    def at_most_ten(df):
        return dq.CheckResult("size", "at most ten rows", dq.LOW, dq.PASS, df.count())

    def breaks(df):
        raise RuntimeError("no luck")

    rules = [
        dq.predicate_rule("cheap", "fee below 9", dq.LOW, F.col("fee") >= 9, F.col("code")),
        dq.table_rule("size", "", dq.LOW, at_most_ten),
        dq.table_rule("broken", "", dq.CRITICAL, breaks),
        dq.predicate_rule("wrong", "", dq.LOW, F.col("no_such_column") > 1),
    ]
    report = dq.run_suite(parcels, "t", rules, "scanned", NOW)
    assert [r.status for r in report.results] == [dq.FAIL, dq.PASS, dq.SKIPPED, dq.SKIPPED]
    assert report.results[0].samples == ("Q-2",)
    assert "no luck" in report.results[2].message


def test_quarantine(spark, parcels):
    good, held = dq.quarantine(parcels, parcel_rules())
    assert good.count() == 1 and good.columns == parcels.columns
    assert {tuple(r["broken_rules"]) for r in held.collect()} == {
        ("not_null_bin",), ("not_null_bin", "range_grams"), ("ref_int_zone",), ("range_grams",), ("regex_code",)
    }


def test_row_rules_share_one_aggregate(spark, parcels):
    measures = {i: F.count_if(r.failing(parcels.schema)) for i, r in enumerate(parcel_rules()) if r.failing is not None}
    text = plan(dq.fused_measures(parcels.repartition(3), measures))
    assert text.count("Aggregate(") == 2  # partial and final
    assert "Python" not in text


def test_samples_are_cut_before_the_shuffle(spark, parcels):
    rules = parcel_rules()
    text = plan(dq.failing_samples(parcels.repartition(3), rules, [1, 2, 4, 6], "scanned"))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_csv_export(spark, parcels, tmp_path):
    report = dq.run_suite(parcels, "parcels", parcel_rules(), "scanned", NOW)
    report.write_csv(spark, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == dq.RESULT_SCHEMA.names and back.count() == 9
