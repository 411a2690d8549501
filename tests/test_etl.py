import os

import pytest
from pyspark.sql import Observation, functions as F

from helpers import D, by_key, plan, rows, ts
from opsflow.context import RunContext
from opsflow.plans import etl
from opsflow.schemas import RUN_LOG, STAGED_INVENTORY
from opsflow.sources import logs, tables

RUN = ts("2024-02-01 00:00:00")
MOVES = (
    "transaction_id string, sku_id string, warehouse_id string, transaction_type string, quantity decimal(18,4),"
    " unit_cost decimal(18,4), transaction_date string, reference_number string, created_by string,"
    " modified_date timestamp_ntz, transaction_status string"
)


def move(tid, kind="RCPT", quantity="5", cost="2", when="2024-01-10 08:00:00", modified="2024-01-10", status="OK", sku="S1", wh="W1"):
    return (
        tid, sku, wh, kind, None if quantity is None else D(quantity), None if cost is None else D(cost), when, "ref", "me",
        ts(modified), status,
    )


def sources(spark, moves):
    return etl.Sources(
        spark.createDataFrame(moves, MOVES),
        spark.createDataFrame([("S1", " red o'neil bolt ", "tools", "EA")], "sku_id string, sku_name string, category string, unit_of_measure string"),
        spark.createDataFrame([("W1", "main DEPOT", "north")], "warehouse_id string, warehouse_name string, region string"),
    )


def cleansed(spark, *moves, dropped=None):
    return etl.transform(etl.extract(sources(spark, moves), ts("2024-01-01")), RUN, dropped)


def test_columns_and_types(spark):
    assert cleansed(spark, move("a")).schema.simpleString() == STAGED_INVENTORY.simpleString()


def test_type_codes_and_signs(spark):
    kinds = {"a": " ship ", "b": "rcpt", "c": "receipt", "d": None, "e": "ADJ-", "f": "foo "}
    got = by_key(cleansed(spark, *[move(k, v, "-5") for k, v in kinds.items()]), "TRANSACTION_ID", "TRANSACTION_TYPE", "SIGNED_QUANTITY")
    assert got == {
        "a": ("SHIPMENT", D("-5.0000")),
        "b": ("RECEIPT", D("5.0000")),
        "c": ("receipt", D("5.0000")),
        "d": (None, D("5.0000")),
        "e": ("ADJUSTMENT_NEGATIVE", D("-5.0000")),
        "f": ("foo ", D("5.0000")),
    }


def test_rows_without_quantity_or_date_are_dropped_and_counted(spark):
    dropped = Observation()
    df = cleansed(spark, move("a"), move("b", quantity=None), move("c", when="soon"), move("d", when=None), dropped=dropped)
    assert rows(df, "TRANSACTION_ID") == [("a",)]
    assert dropped.get["rows"] == 3


def test_calendar_text_and_cost(spark):
    got = cleansed(spark, move("a", quantity="1", cost="0.125", when="2024-12-30")).first()
    assert (got["TRANSACTION_YEAR"], got["TRANSACTION_MONTH"], got["TRANSACTION_WEEK"]) == (2024, 12, 1)
    assert got["EXTENDED_COST"] == D("0.12")
    assert (got["SKU_NAME"], got["WAREHOUSE_NAME"], got["REGION"]) == ("Red O'Neil Bolt", "Main Depot", "North")
    assert got["LOAD_TIMESTAMP"] == RUN


def test_extended_cost_is_unsigned_by_type(spark):
    assert cleansed(spark, move("a", "SHIP", "4", "2.5")).first()["EXTENDED_COST"] == D("10.00")


def test_extract_filters(spark):
    kept = etl.extract(
        sources(
            spark,
            [
                move("edge", modified="2024-01-05"),
                move("old", modified="2024-01-04"),
                move("void", status="VOIDED"),
                move("no status", status=None),
                move("no sku", sku="S9"),
                move("no warehouse", wh="W9"),
            ],
        ),
        ts("2024-01-05"),
    )
    assert rows(kept, "transaction_id") == [("edge",)]


def test_missing_optional_columns(spark):
    raw = etl.extract(sources(spark, [move("a")]), ts("2024-01-01")).drop("reference_number", "created_by", "modified_date")
    got = etl.transform(raw, RUN).first()
    assert got["REFERENCE_NUMBER"] is None and got["MODIFIED_DATE"] is None


def test_names_cleaned_before_the_join_give_the_same_rows(spark):
    src = sources(spark, [move("a"), move("b", " ship ")])
    assert rows(etl.cleansed(src, ts("2024-01-01"), RUN)) == rows(etl.transform(etl.extract(src, ts("2024-01-01")), RUN))


def test_source_names(spark):
    df = spark.createDataFrame([("S1", "bolt", "tools", "EA")], "SKU_ID string, SKUName string, Category string, UOM string")
    assert etl.renamed(df, etl.SKU_COLUMNS).columns == ["sku_id", "sku_name", "category", "unit_of_measure"]


def test_runs_in_sequence(spark, tmp_path):
    target, log = str(tmp_path / "t"), str(tmp_path / "l")
    first = etl.run_pipeline(
        sources(spark, [move("a"), move("ancient", modified="2023-01-01"), move("x", quantity=None)]), target, log, RunContext.at(RUN)
    )
    assert (first.rows_loaded, first.rows_dropped, first.watermark) == (1, 1, ts("2023-11-03"))
    # Changed at the very time of the first run, then once more by the third.
    later = sources(spark, [move("a"), move("b", modified="2024-02-01"), move("c", modified="2024-02-03")])
    second = etl.run_pipeline(later, target, log, RunContext.at(ts("2024-02-02")))
    assert (second.watermark, second.rows_loaded) == (RUN, 2)
    repeated = etl.run_pipeline(later, target, log, RunContext.at(ts("2024-02-04")), skip_loaded=True)
    assert (repeated.watermark, repeated.rows_loaded) == (ts("2024-02-02"), 0)
    full = etl.run_pipeline(later, target, log, RunContext.at(ts("2024-02-05")), full_load=True)
    assert (full.watermark, full.rows_loaded) == (ts("2023-11-07"), 3)
    assert spark.read.schema(STAGED_INVENTORY).parquet(target).count() == 6
    assert os.path.isdir(f"{target}/TRANSACTION_YEAR=2024/TRANSACTION_MONTH=1")
    entries = spark.read.schema(RUN_LOG).parquet(log)
    assert rows(entries, "load_timestamp", "rows_loaded", "status") == [
        (RUN, 1, "SUCCESS"),
        (ts("2024-02-02"), 2, "SUCCESS"),
        (ts("2024-02-04"), 0, "SUCCESS"),
        (ts("2024-02-05"), 3, "SUCCESS"),
    ]


def test_a_new_cost_is_not_taken_for_a_repeat(spark, tmp_path):
    target, log = str(tmp_path / "t"), str(tmp_path / "l")
    etl.run_pipeline(sources(spark, [move("a")]), target, log, RunContext.at(ts("2024-01-09")))
    changed = sources(spark, [move("a", cost="9", modified="2024-01-11")])
    assert etl.run_pipeline(changed, target, log, RunContext.at(RUN), skip_loaded=True).rows_loaded == 1


def test_failure_is_logged_and_does_not_move_the_watermark(spark, tmp_path):
    target, log = str(tmp_path / "t"), str(tmp_path / "l")
    etl.run_pipeline(sources(spark, [move("a")]), target, log, RunContext.at(RUN))
    good = sources(spark, [move("b")])
    broken = etl.Sources(good.movements.withColumn("unit_cost", F.raise_error(F.lit("disk on fire"))), good.skus, good.warehouses)
    with pytest.raises(Exception, match="disk on fire"):
        etl.run_pipeline(broken, target, log, RunContext.at(ts("2024-03-01")), full_load=True)
    assert logs.last_success(spark, log, etl.PIPELINE) == RUN
    failed = spark.read.schema(RUN_LOG).parquet(log).where("status = 'FAILURE'").first()
    assert failed["rows_loaded"] == 0 and "disk on fire" in failed["error_message"]


def test_first_run_and_unreadable_log(spark, tmp_path):
    assert logs.last_success(spark, str(tmp_path / "none"), "x") is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):  # not a silent load from the default reach
        logs.last_success(spark, str(tmp_path / "bad"), "x")


def test_reach_of_a_full_load(spark, tmp_path):
    for reach, wanted in ((1, 0), (None, 1)):
        target, log = str(tmp_path / f"t{reach}"), str(tmp_path / f"l{reach}")
        run = RunContext.at(ts("2030-01-01"))
        result = etl.run_pipeline(sources(spark, [move("a")]), target, log, run, full_load=True, lookback_days=reach)
        assert result.rows_loaded == wanted


def test_no_python_in_the_plan(spark):
    text = plan(cleansed(spark, move("a")))
    assert "Python" not in text and "BatchEval" not in text


def test_watermark_reaches_the_scan(spark, tmp_path):
    src = sources(spark, [move("a")])
    src.movements.write.parquet(str(tmp_path / "m"))
    stored = etl.modified_since(spark.read.parquet(str(tmp_path / "m")), RUN)
    assert "GreaterThanOrEqual(modified_date" in plan(stored)


def test_jdbc_options():
    options = tables.jdbc_options("jdbc:db", "dbo.T", "id", ("1", "100"), 8, user="u")
    assert options["numPartitions"] == "8" and options["lowerBound"] == "1" and options["user"] == "u"
    assert "partitionColumn" not in tables.jdbc_options("jdbc:db", "dbo.T")
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:db", "dbo.T", "id")


def test_catalog_table(spark, tmp_path):
    path = str(tmp_path / "table")
    for _ in range(2):
        tables.create_if_missing(spark, "opsflow_log_table", RUN_LOG, path)
    row = tables.literal_table(spark, [("p", RUN, 1, "SUCCESS", None)], RUN_LOG)
    tables.insert_select(row.select(*reversed(RUN_LOG.names)), "opsflow_log_table")
    assert rows(tables.read_table(spark, "opsflow_log_table")) == rows(row)
    assert tables.read_table(spark, path, RUN_LOG).count() == 1
    spark.sql("DROP TABLE opsflow_log_table")
