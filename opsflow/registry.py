"""The library's jobs and operators run over the test tables, one callable per name.

All dates are fixed, so a query gives the same rows on every run.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DecimalType, IntegerType, StructField, StructType

from opsflow.context import RunContext, months_back
from opsflow.functions.text import starts_with_match
from opsflow.functions.numeric import lenient_double
from opsflow.operators import (
    changes as chg, flatten, intervals, joins, layout, masking, quality as dq, ranking, rolling, sketches, versions,
)
from opsflow.plans import anomaly, close, close_script, etl, reconcile, reports, scorecard, summary
from opsflow.schemas import DELIVERY_LOG, INVENTORY_FACT, MONTHLY_CLOSE, RUN_LOG, STAGED_INVENTORY, conform
from opsflow.session import staged, work_path
from opsflow.sources.logs import delivery_manifest
from opsflow.sources.tables import create_if_missing, insert_select, is_folder, literal_table, path_exists
from opsflow.sources.views import view
from opsflow.streaming import cdc, feed as log_feed, load, summary as summary_stream

REPORT_DAY = date(2024, 1, 30)
SCORE_DAY = date(2001, 8, 1)
LEDGER_START, LEDGER_END = date(1995, 1, 1), date(2001, 12, 31)
RUN_TS = datetime(2024, 1, 31)
EARLIER_TS = datetime(2024, 1, 24, 12)
WATERMARK, MID_WATERMARK = datetime(2024, 1, 1), datetime(2024, 1, 15)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _as_doubles(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparing values across engines; the jobs keep them exact."""
    money = [f.name for f in rows.schema if isinstance(f.dataType, DecimalType)]
    return rows.withColumns({c: F.col(c).cast("double") for c in money})


def _positioned(rows: DataFrame, *columns: str) -> DataFrame:
    """Columns of a sorted report with the place of each row, as an engine-neutral form of its order."""
    numbered = rows.withColumn("_at", F.monotonically_increasing_id())
    return ranking.row_number_at_scale(numbered, [], [F.col("_at")], "place").select("place", *columns)


# --- inventory anomalies ---------------------------------------------------


@query
def inventory_anomaly(spark, sf):
    return anomaly.inventory_anomaly_report(
        view(spark, sf, "fx_inventory"), view(spark, sf, "fx_sku_master"), REPORT_DAY, lookback_days=90
    )


@query
def inventory_rolling_stats(spark, sf):
    rows = anomaly.scored(anomaly.daily_inventory(view(spark, sf, "fx_inventory")))
    return rows.select(
        *anomaly.SERIES,
        "transaction_date",
        *[F.col(c).cast("double").alias(c) for c in ("daily_qty", "daily_received", "daily_shipped")],
        F.round(F.col("rolling_avg").cast("decimal(30,6)"), 4).cast("double").alias("rolling_avg"),
        F.round(F.col("rolling_stddev").cast("decimal(30,6)"), 4).cast("double").alias("rolling_stddev"),
        F.col("prior_day").cast("double").alias("prior_day"),
        F.col("prior_week").cast("double").alias("prior_week"),
        "z_score",
        "dod_pct_change",
        "wow_pct_change",
    )


@query
def inventory_severity_all_days(spark, sf):
    return anomaly.anomalies_all_days(
        view(spark, sf, "fx_inventory"), view(spark, sf, "fx_sku_master"), REPORT_DAY, lookback_days=90
    )


@query
def inventory_z_excluding_current(spark, sf):
    rows = anomaly.scored(anomaly.daily_inventory(view(spark, sf, "fx_inventory")), exclude_current=True)
    return rows.select(*anomaly.SERIES, "transaction_date", "z_score")


@query
def inventory_severity_excluding_current(spark, sf):
    """Severities against the seven rows before the current one, where a z-score can exceed 3."""
    rows = anomaly.anomalies_all_days(
        view(spark, sf, "fx_inventory"), view(spark, sf, "fx_sku_master"), REPORT_DAY, exclude_current=True
    )
    return rows.select("transaction_date", "sku_id", "warehouse_id", "anomaly_severity", "anomaly_reason", "z_score")


@query
def inventory_anomaly_order(spark, sf):
    return _positioned(inventory_anomaly(spark, sf), "anomaly_severity", "sku_id", "warehouse_id")


@query
def inventory_dense_days(spark, sf):
    daily = anomaly.daily_inventory(view(spark, sf, "fx_inventory"))
    dense = rolling.fill_missing_days(daily, anomaly.SERIES, "transaction_date", "daily_qty")
    return dense.withColumn("daily_qty", F.col("daily_qty").cast("double"))


# --- supplier scorecard ----------------------------------------------------


def _order_lines(spark, sf):
    return scorecard.recent_lines(view(spark, sf, "fx_purchase_orders"), SCORE_DAY)


@query
def supplier_scorecard(spark, sf):
    return _as_doubles(scorecard.supplier_scorecard(
        view(spark, sf, "fx_purchase_orders"), view(spark, sf, "fx_receipts"), view(spark, sf, "fx_suppliers"), SCORE_DAY
    ))


@query
def supplier_scorecard_order(spark, sf):
    return _positioned(supplier_scorecard(spark, sf), "supplier_id", "composite_score")


@query
def supplier_scorecard_planted(spark, sf):
    """Scores of every status: late suppliers, suppliers with many rejects, and ones without a price to compare."""
    group = F.col("supplier_id") % 5
    orders = view(spark, sf, "fx_purchase_orders").withColumns({
        "actual_delivery_date": F.when(group != 1, F.col("actual_delivery_date")),
        "received_qty": F.when(group == 2, F.col("received_qty") / 2).otherwise(F.col("received_qty")).cast("decimal(18,4)"),
        "unit_price_ordered": F.when(group == 3, 0).otherwise(F.col("unit_price_ordered")).cast("decimal(18,4)"),
    })
    receipts = view(spark, sf, "fx_receipts").withColumn(
        "rejected_qty", F.when(group == 1, F.col("received_qty")).otherwise(F.col("rejected_qty")).cast("decimal(18,4)")
    )
    card = scorecard.supplier_scorecard(orders, receipts, view(spark, sf, "fx_suppliers"), SCORE_DAY)
    return card.select("supplier_id", "composite_score", "supplier_status", "rank_within_tier", "performance_quartile")


@query
def supplier_delivery(spark, sf):
    return scorecard.supplier_measures(_order_lines(spark, sf), SCORE_DAY).select(
        "supplier_id",
        "total_pos",
        "total_ordered_qty",
        "total_received_qty",
        "fill_rate_pct",
        "on_time_delivery_pct",
        "avg_delay_days_when_late",
        "max_delay_days",
    )


@query
def supplier_price_variance(spark, sf):
    return scorecard.supplier_measures(_order_lines(spark, sf), SCORE_DAY, count_orders=False).select(
        "supplier_id",
        "total_line_items",
        "accurate_invoice_lines",
        "avg_price_variance_pct",
        F.round("total_invoice_variance_usd", 2).cast("double").alias("total_invoice_variance_usd"),
    )


@query
def supplier_quality(spark, sf):
    return scorecard.receipt_quality(view(spark, sf, "fx_receipts"), SCORE_DAY)


@query
def supplier_quarters(spark, sf):
    return scorecard.supplier_measures(_order_lines(spark, sf), SCORE_DAY, count_orders=False).select(
        "supplier_id", "otd_pct_current_qtr", "otd_pct_prior_qtr"
    )


ORDER_MONTHS = ("1996-01-01", "1996-07-01")


@query
def supplier_orders_estimated(spark, sf):
    """Orders per supplier in half a year, by sketches stored per supplier and month, beside the exact count."""
    path = work_path(spark, "order-sketches")
    lines = view(spark, sf, "fx_purchase_orders").withColumn("month", F.date_trunc("month", "po_date").cast("date"))
    sketches.distinct_sketches(lines, ["supplier_id", "month"], "po_id").write.parquet(path)
    first, following = (F.lit(m).cast("date") for m in ORDER_MONTHS)
    stored = spark.read.parquet(path).where((F.col("month") >= first) & (F.col("month") < following))
    estimated = sketches.merged_counts(stored, ["supplier_id"], "estimate")
    window = lines.where((F.col("po_date") >= first) & (F.col("po_date") < following))
    exact = window.groupBy("supplier_id").agg(F.count_distinct("po_id").alias("orders"))
    return exact.join(estimated, "supplier_id", "left").select(
        "supplier_id", "orders", F.coalesce(sketches.within("estimate", "orders"), F.lit(False)).alias("within_bound")
    )


# --- ledger reconciliation -------------------------------------------------


def _ledgers(spark, sf):
    return [view(spark, sf, n) for n in ("fx_ap_invoices", "fx_gl_invoices", "fx_vendors")]


@query
def recon_exceptions(spark, sf):
    return _as_doubles(reconcile.reconciliation_exceptions(*_ledgers(spark, sf), LEDGER_START, LEDGER_END))


@query
def recon_exceptions_order(spark, sf):
    return _positioned(recon_exceptions(spark, sf), "variance_severity", "invoice_number", "vendor_id")


@query
def recon_vendor_summary(spark, sf):
    return _as_doubles(reconcile.reconciliation_vendor_summary(*_ledgers(spark, sf), LEDGER_START, LEDGER_END))


@query
def recon_classified(spark, sf):
    rows = reconcile.classified(*_ledgers(spark, sf), LEDGER_START, LEDGER_END)
    return rows.groupBy("discrepancy_type", "variance_severity").agg(
        F.count("*").alias("invoices"),
        F.sum("in_wms").alias("in_wms"),
        F.sum("in_erp").alias("in_erp"),
        F.sum("gross_amount_variance").cast("double").alias("gross_amount_variance"),
    )


@query
def result_reuse(spark, sf):
    """One stored result read by several follow-up questions."""
    rows = staged(reconcile.classified(*_ledgers(spark, sf), LEDGER_START, LEDGER_END), "classified")
    vendors = rows.select("vendor_id").distinct().agg(F.count("vendor_id").alias("vendors"))
    counts = rows.agg(
        F.count("*").alias("rows_found"), F.count_if(F.col("discrepancy_type") != "MATCHED").alias("exceptions")
    )
    return counts.withColumn("vendors", vendors.scalar())


@query
def recon_duplicate_keys(spark, sf):
    ap = view(spark, sf, "fx_ap_invoices")
    return joins.duplicate_keys(reconcile.wms_invoices(ap, LEDGER_START, LEDGER_END), ["invoice_number", "vendor_id"])


# --- incremental load ------------------------------------------------------


def _sources(spark, sf, **replaced):
    return etl.Sources(
        view(spark, sf, "fx_movements", **replaced), view(spark, sf, "fx_sku_master"), view(spark, sf, "fx_warehouses")
    )


def _transformed(spark, sf, watermark):
    return etl.cleansed(_sources(spark, sf), watermark, RUN_TS)


@query
def etl_transformed(spark, sf):
    return _as_doubles(_transformed(spark, sf, WATERMARK))


@query
def etl_incremental(spark, sf):
    rows = etl.modified_since(view(spark, sf, "fx_movements"), MID_WATERMARK)
    return rows.select("transaction_id", "sku_id", "warehouse_id", "transaction_type", "modified_date")


def _text_dated(spark, sf):
    """Extracted movements whose dates are text in several forms, one of them unreadable."""
    rows = etl.extract(_sources(spark, sf), None)
    when, form = F.col("transaction_date"), F.col("transaction_id") % 5
    text = (
        F.when(form == 0, F.date_format(when, "yyyy-MM-dd HH:mm:ss")).when(form == 1, F.date_format(when, "MM/dd/yyyy"))
        .when(form == 2, F.date_format(when, "yyyyMMdd")).when(form == 3, F.date_format(when, "dd.MM.yyyy")).otherwise("soon")
    )
    return rows.withColumn("transaction_date", text)


TEXT_FORMATS = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy", "yyyyMMdd", "dd.MM.yyyy")


@query
def etl_text_dates(spark, sf):
    rows = etl.transform(_text_dated(spark, sf), RUN_TS, formats=TEXT_FORMATS)
    return rows.select("TRANSACTION_ID", "TRANSACTION_DATE", "TRANSACTION_WEEK")


@query
def etl_quarantined(spark, sf):
    """The rows that the cleansing leaves out, with what could not be read."""
    return etl.quarantined(_text_dated(spark, sf), TEXT_FORMATS).select("transaction_id", "transaction_date", "unreadable")


def _two_runs(spark, sf):
    """Two logged runs into one table: up to the middle of the month, then what changed since."""
    root = work_path(spark, "etl")
    target, log = posixpath.join(root, "target"), posixpath.join(root, "log")
    sources = _sources(spark, sf)
    first_half = etl.Sources(
        sources.movements.where(F.col("modified_date") < F.lit(MID_WATERMARK).cast("timestamp_ntz")),
        sources.skus,
        sources.warehouses,
    )
    etl.run_pipeline(first_half, target, log, RunContext.at(MID_WATERMARK), full_load=True, lookback_days=None)
    etl.run_pipeline(sources, target, log, RunContext.at(RUN_TS), skip_loaded=True)
    return spark.read.schema(STAGED_INVENTORY).parquet(target), spark.read.schema(RUN_LOG).parquet(log)


@query
def etl_run_log(spark, sf):
    _, log = _two_runs(spark, sf)
    return log.drop("error_message")


@query
def etl_pipeline_run(spark, sf):
    loaded, _ = _two_runs(spark, sf)
    return loaded.groupBy("TRANSACTION_YEAR", "TRANSACTION_MONTH", "WAREHOUSE_ID", "LOAD_TIMESTAMP").agg(
        F.count("*").alias("ROWS_LOADED"),
        F.count_distinct("ROW_HASH").alias("DISTINCT_ROWS"),
        F.sum("EXTENDED_COST").cast("double").alias("EXTENDED_COST"),
    )


# --- data quality ----------------------------------------------------------

WAREHOUSE_CODES = ("WH-01", "WH-02", "WH-03")
TYPE_CODES = ("RCPT", " ship ", "ADJ+", "ADJ-")


def _rules(skus):
    return [
        dq.row_count_threshold(1),
        dq.not_null("transaction_id"),
        dq.is_unique("transaction_id"),
        dq.is_unique("transaction_date", dq.LOW),
        dq.not_null("quantity", dq.HIGH),
        dq.in_range("quantity", 0, 250),
        dq.in_range("reference_number", 0, 1, dq.LOW),
        dq.matches_regex("transaction_type", r"[A-Z]{3,4}[+-]?$"),
        dq.referential_integrity("warehouse_id", WAREHOUSE_CODES),
        dq.referential_integrity("transaction_type", TYPE_CODES),
        dq.referential_integrity("sku_id", skus, allowed_column="sku_id"),
        dq.freshness("transaction_date", RUN_TS, 12),
        dq.not_null("bin_code", dq.MEDIUM),
    ]


def _checked(spark, sf):
    """Movements of which some name a SKU that does not exist."""
    lost = F.when(F.col("transaction_id") % 37 == 0, -F.col("sku_id")).otherwise(F.col("sku_id"))
    return view(spark, sf, "fx_movements").withColumn("sku_id", lost)


def _report(spark, sf):
    return dq.run_suite(
        _checked(spark, sf), "movements", _rules(view(spark, sf, "fx_sku_master")), "transaction_id", RUN_TS
    )


@query
def dq_results(spark, sf):
    return _report(spark, sf).results_frame(spark)


@query
def dq_failed_order(spark, sf):
    """Failed rules in the order of their severity's name."""
    failed = [(place, r.rule_id, r.severity) for place, r in enumerate(_report(spark, sf).failed, 1)]
    return spark.createDataFrame(failed, "place int, rule_id string, severity string")


@query
def dq_gate(spark, sf):
    """The gate's answer for two suites over the movements: one passes, one blocks."""
    rows = _checked(spark, sf)
    suites = {
        "open": [dq.not_null("transaction_id"), dq.not_null("quantity", dq.HIGH)],
        "shut": [dq.not_null("quantity"), dq.not_null("warehouse_id"), dq.is_unique("sku_id")],
    }
    answers = []
    for name, rules in suites.items():
        try:
            dq.run_suite(rows, name, rules, "transaction_id", RUN_TS).raise_on_critical()
            answers.append((name, False, None))
        except ValueError as blocked:
            answers.append((name, True, str(blocked)))
    return spark.createDataFrame(answers, "suite string, blocked boolean, message string")


@query
def dq_custom_rules(spark, sf):
    """A caller's own row predicate and own function of the table."""

    def few_warehouses(df):
        found = df.select("warehouse_id").distinct().count()
        status = dq.PASS if found <= 3 else dq.FAIL
        return dq.CheckResult("few_warehouses", "at most three warehouses", dq.LOW, status, df.count(), found)

    dear = dq.predicate_rule("dear", "unit cost below 14", dq.LOW, F.col("unit_cost") >= 14, F.col("transaction_id"))
    rules = [dear, dq.table_rule("few_warehouses", "at most three warehouses", dq.LOW, few_warehouses)]
    return dq.run_suite(_checked(spark, sf), "own", rules, "transaction_id", RUN_TS).results_frame(spark)


@query
def dq_export(spark, sf):
    """The report written as CSV with a header and read back."""
    path = work_path(spark, "dq-csv")
    _report(spark, sf).write_csv(spark, path)
    back = spark.read.option("header", True).schema(dq.RESULT_SCHEMA).csv(path)
    return back


@query
def dq_summary(spark, sf):
    return _report(spark, sf).summary_frame(spark)


@query
def dq_duplicates(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    rows = joins.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query
def dq_orphans(spark, sf):
    """Receipts of which some name a supplier that does not exist."""
    lost = F.when(F.col("grn_id") % 11 == 0, -F.col("supplier_id")).otherwise(F.col("supplier_id"))
    receipts = view(spark, sf, "fx_receipts").withColumn("supplier_id", lost)
    return joins.outside_reference(receipts, "supplier_id", view(spark, sf, "fx_suppliers"), "supplier_id")


@query
def dq_regex_failures(spark, sf):
    rows = view(spark, sf, "fx_movements")
    return rows.where(~starts_with_match(F.col("transaction_type"), "[A-Z]{3}")).select(
        "transaction_id", "transaction_type"
    )


@query
def dq_range_failures(spark, sf):
    value = lenient_double(F.col("quantity"))
    rows = view(spark, sf, "fx_movements").where((value < 1) | (value > 200))
    return rows.select("transaction_id", F.col("quantity").cast("double").alias("quantity"))


@query
def dq_quarantine(spark, sf):
    rules = [
        dq.not_null("quantity"),
        dq.in_range("quantity", 0, 250),
        dq.referential_integrity("warehouse_id", WAREHOUSE_CODES),
    ]
    _, held = dq.quarantine(view(spark, sf, "fx_movements"), rules)
    return held.select("transaction_id", F.array_join("broken_rules", ",").alias("broken_rules"))


# --- change capture and versions -------------------------------------------

FACT_KEY, FACT_UPDATES = "transaction_id", ("quantity", "unit_cost")


def _versions(spark, sf):
    return view(spark, sf, "fx_txn_before"), view(spark, sf, "fx_txn_after")


def _fact(rows, stamp):
    return conform(rows.withColumn("last_updated_ts", F.lit(stamp).cast("timestamp_ntz")), INVENTORY_FACT)


def _fact_values(rows):
    return rows.withColumns({c: F.col(c).cast("double") for c in FACT_UPDATES})


@query
def change_feed(spark, sf):
    return _fact_values(chg.changes(*_versions(spark, sf), FACT_KEY))


@query
def change_feed_append_only(spark, sf):
    return _fact_values(chg.changes(*_versions(spark, sf), FACT_KEY, append_only=True))


@query
def merge_changes(spark, sf):
    before, after = _versions(spark, sf)
    feed = chg.changes(before, after, FACT_KEY)
    return _fact_values(chg.merge_changes(_fact(before, EARLIER_TS), feed, FACT_KEY, FACT_UPDATES, RUN_TS))


def _store_by_commit(feed, folder, commits):
    """A change feed computed once and dealt out by key to so many commits, each a folder of as many files as its rows need."""
    dealt = feed.withColumn("commit", F.pmod(F.xxhash64(FACT_KEY), F.lit(commits)).cast("int") + 1)
    # The rebalance gathers small commits in few files and leaves a large one to many tasks.
    dealt.hint("rebalance", F.col("commit")).write.partitionBy("commit").parquet(folder)


def _commits_of(spark, folder, commits, schema):
    """The commits of ``_store_by_commit`` in their order; each has its rows, of which there may be none."""
    stored = spark.read.schema(StructType([*schema, StructField("commit", IntegerType())])).parquet(folder)
    return [stored.where(F.col("commit") == c).drop("commit") for c in range(1, commits + 1)]


def _drain(commits, folder, run):
    """Every commit is appended to the stream's folder, in its own files, and drained: whatever their number, they are one micro-batch."""
    for rows in commits:
        rows.write.mode("append").parquet(folder)
        run()


def _files_of_a_fourth(spark, folder):
    """Files a micro-batch, to read a folder in about four."""
    return max(1, len(spark.read.parquet(folder).inputFiles()) // 4)


def _stream_fact(spark, sf, sequence=None):
    """The older version as a fact table, the feed to the newer one in four commits, and the folder they are streamed from."""
    before, after = _versions(spark, sf)
    root = work_path(spark, "cdc")
    table = cdc.FactTable(posixpath.join(root, "fact"), INVENTORY_FACT, FACT_KEY, FACT_UPDATES, buckets=8, sequence=sequence)
    images = before.withColumns({chg.ACTION: F.lit("INSERT"), chg.IS_UPDATE: F.lit(False)})
    cdc.merge_batch(images.withColumn("commit_id", F.lit(0)) if sequence else images, table, EARLIER_TS)
    feed = chg.changes(before, after, FACT_KEY)
    # Both images of an update have one key, so they reach the same commit and micro-batch.
    _store_by_commit(feed, posixpath.join(root, "changes"), 4)
    commits = _commits_of(spark, posixpath.join(root, "changes"), 4, feed.schema)
    if sequence:
        commits = [rows.withColumn("commit_id", F.lit(number)) for number, rows in enumerate(commits, 1)]
    return table, commits, root


@query
def cdc_stream(spark, sf):
    """The same merge, fed by a file stream in several micro-batches."""
    table, commits, root = _stream_fact(spark, sf)
    folder = posixpath.join(root, "feed")

    def run():
        source = load.file_stream(spark, folder, commits[0].schema)
        cdc.run_cdc_stream(source, table, posixpath.join(root, "checkpoint"), RUN_TS).awaitTermination()

    _drain(commits, folder, run)
    return _fact_values(table.read(spark))


@query
def cdc_stream_restarted(spark, sf):
    """The same again, and then once more from the start under a fresh checkpoint, a month later: nothing may change."""
    table, commits, root = _stream_fact(spark, sf, sequence="commit_id")
    folder = posixpath.join(root, "feed")

    def run(checkpoint, stamp, files_per_batch=None):
        source = load.file_stream(spark, folder, commits[0].schema, files_per_batch)
        cdc.run_cdc_stream(source, table, posixpath.join(root, checkpoint), stamp).awaitTermination()

    _drain(commits, folder, lambda: run("first", RUN_TS))
    run("second", datetime(2024, 2, 29), _files_of_a_fourth(spark, folder))
    return _fact_values(table.read(spark))


@query
def change_feed_from_log(spark, sf):
    """What a consumer of the commit log gets: half of the log in its second try, the first of which fails, then the rest."""
    log = view(spark, sf, "fx_commit_log")
    root = work_path(spark, "log-feed")
    offsets, got = posixpath.join(root, "offsets"), posixpath.join(root, "feed")
    middle = F.col("commit_ts") < F.lit(MID_WATERMARK).cast("timestamp_ntz")

    def failing(feed, upto):
        raise InterruptedError("the consumer was stopped")

    def store(run):
        return lambda feed, upto: feed.withColumn("run", F.lit(run)).write.mode("append").parquet(got)

    try:
        log_feed.consume(log.where(middle), LOG_KEY, offsets, "reader", failing, EARLIER_TS)
    except InterruptedError:
        log_feed.consume(log.where(middle), LOG_KEY, offsets, "reader", store(1), EARLIER_TS)
    log_feed.consume(log, LOG_KEY, offsets, "reader", store(2), RUN_TS)
    log_feed.consume(log, LOG_KEY, offsets, "reader", store(3), RUN_TS)  # nothing is left
    return _quantities(spark.read.parquet(got))


@query
def change_feed_log_append_only(spark, sf):
    """Keys that the second half of the commit log has brought, of a log without DELETE rows for them."""
    log = view(spark, sf, "fx_commit_log")
    half = log.where(F.col("commit_ts") < F.lit(datetime(2024, 1, 3)).cast("timestamp_ntz"))
    feed = log_feed.feed_between(log, LOG_KEY, log_feed.newest_commit(half), log_feed.newest_commit(log), append_only=True)
    return _quantities(feed)


@query
def merge_ordered_changes(spark, sf):
    """One batch with many changes of a key: updates, deletes, re-inserts and plain inserts, in the order of their commits."""
    log = view(spark, sf, "fx_commit_log")
    target = versions.as_of(log, ["sku_id"], MID_WATERMARK).drop("commit_ts", "commit_id")
    target = target.withColumn("last_updated_ts", F.lit(EARLIER_TS).cast("timestamp_ntz"))
    is_delete = F.col("action") == "DELETE"
    feed = log.where(F.col("commit_ts") > F.lit(MID_WATERMARK).cast("timestamp_ntz")).select(
        "sku_id", "channel", "quantity", "commit_id",
        F.when(is_delete, "DELETE").otherwise("INSERT").alias(chg.ACTION),
        (~is_delete & (F.col("commit_id") % 3 > 0)).alias(chg.IS_UPDATE),
    )
    return _quantities(chg.merge_changes(target, feed, "sku_id", ["quantity"], RUN_TS, sequence="commit_id"))


LOG_KEY = ["sku_id", "channel"]


def _quantities(rows):
    return rows.withColumn("quantity", F.col("quantity").cast("double"))


@query
def as_of_state(spark, sf):
    return _quantities(versions.as_of(view(spark, sf, "fx_commit_log"), LOG_KEY, MID_WATERMARK))


def _bad_commit(log):
    """The commit to go back behind: the last one before 20 January."""
    early = log.where(F.col("commit_ts") < F.lit(datetime(2024, 1, 20)).cast("timestamp_ntz"))
    return early.agg(F.max("commit_id")).first()[0]


@query
def as_of_before_commit(spark, sf):
    log = view(spark, sf, "fx_commit_log")
    return _quantities(versions.before_commit(log.drop("channel"), ["sku_id"], _bad_commit(log)))


@query
def added_since(spark, sf):
    return _quantities(versions.added_since(view(spark, sf, "fx_commit_log"), LOG_KEY, datetime(2024, 1, 3)))


@query
def restore_state(spark, sf):
    log = view(spark, sf, "fx_commit_log")
    return _quantities(versions.restore(log, LOG_KEY, _bad_commit(log), work_path(spark, "restored")))


def _table_name(label):
    return f"opsflow_{label}_{uuid.uuid4().hex}"


@query
def restore_table_state(spark, sf):
    """A catalog table of the newest state, restored in place to the state before a commit."""
    log, name = view(spark, sf, "fx_commit_log"), _table_name("restored")
    newest = versions.latest_state(log, LOG_KEY)
    path = work_path(spark, "newest")
    newest.write.parquet(path)
    create_if_missing(spark, name, newest.schema, path)
    table = versions.restore_table(log, LOG_KEY, _bad_commit(log), name, work_path(spark, "restored"))
    rows = _quantities(table)
    spark.sql(f"DROP TABLE {name}")  # the entry, not the files
    return rows


# --- daily summary ---------------------------------------------------------


def _movements(spark, sf, watermark=WATERMARK):
    rows = _transformed(spark, sf, watermark)
    return rows.toDF(*[c.lower() for c in rows.columns])


def _summary_view(state):
    return _as_doubles(summary.summary_view(state))


@query
def daily_summary(spark, sf):
    return _as_doubles(summary.daily_summary(_movements(spark, sf)))


@query
def daily_summary_recent(spark, sf):
    return _as_doubles(summary.recent_summary(summary.daily_summary(_movements(spark, sf)), date(2024, 4, 15)))


@query
def daily_summary_incremental(spark, sf):
    rows = _movements(spark, sf)
    early = F.col("transaction_date") < F.lit(MID_WATERMARK).cast("timestamp_ntz")
    stored = summary.summary_state(rows.where(early))
    return _summary_view(summary.refresh(stored, summary.summary_state(rows.where(~early))))


def _typed_versions(spark, sf):
    return [
        v.withColumns({
            "transaction_type": F.when(F.col("transaction_id") % 3 == 0, "SHIPMENT").otherwise("RECEIPT"),
            "category": F.col("warehouse_id"),
        })
        for v in _versions(spark, sf)
    ]


@query
def daily_summary_from_changes(spark, sf):
    """Summary of one table version, moved to the next version by its change feed alone."""
    typed = _typed_versions(spark, sf)
    stored = summary.summary_state(typed[0])
    delta = summary.state_of_changes(chg.changes(*typed, FACT_KEY))
    return _summary_view(summary.refresh(stored, delta))


@query
def daily_summary_table(spark, sf):
    """A stored summary folded twice, one part of the month at a time, and each fold repeated."""
    rows = _movements(spark, sf)
    early = F.col("transaction_date") < F.lit(MID_WATERMARK).cast("timestamp_ntz")
    path = work_path(spark, "summary-table")
    for number, part in enumerate((early, ~early)):
        for _ in range(2):
            summary.fold(path, rows.where(part), F.lit(number))
    return _summary_view(summary.read_state(spark, path))


@query
def daily_summary_change_stream(spark, sf):
    """A summary kept by a stream of inserts, then updates and deletes, in several micro-batches, and read again from the start."""
    before, after = _typed_versions(spark, sf)
    root = work_path(spark, "summary-changes")
    folder, path = posixpath.join(root, "feed"), posixpath.join(root, "summary")
    images = before.withColumns({chg.ACTION: F.lit("INSERT"), chg.IS_UPDATE: F.lit(False)})
    feed = chg.changes(before, after, FACT_KEY)
    _store_by_commit(feed, posixpath.join(root, "changes"), 3)
    commits = [images.select(feed.columns), *_commits_of(spark, posixpath.join(root, "changes"), 3, feed.schema)]
    commits = [rows.withColumn("commit_id", F.lit(number)) for number, rows in enumerate(commits)]

    def run(checkpoint, files_per_batch=None):
        source = load.file_stream(spark, folder, commits[0].schema, files_per_batch)
        summary_stream.run_summary_stream(source, path, posixpath.join(root, checkpoint), "commit_id").awaitTermination()

    _drain(commits, folder, lambda: run("first"))
    run("second", _files_of_a_fourth(spark, folder))
    return _summary_view(summary.read_state(spark, path))


@query
def daily_summary_range(spark, sf):
    """Three months of a summary stored by month, of movements spread over eight months."""
    rows = _movements(spark, sf)
    moved = F.date_add(F.to_date("transaction_date"), F.col("transaction_id").cast("int") % 8 * 31)
    path = work_path(spark, "summary-range")
    summary.fold(path, rows.withColumn("transaction_date", moved), F.lit(0))
    return _summary_view(summary.read_state(spark, path, since=months_back(date(2024, 8, 20), 3)))


def _event_stream(spark, sf, name):
    path = posixpath.join(sf, "events.parquet")
    schema = spark.read.parquet(path).schema
    # A stream reads a folder; the filter on names would not match the part files of a table that is one itself.
    stream = load.file_stream(spark, path, schema) if is_folder(spark, path) else load.file_stream(spark, sf, schema, name_glob="events.parquet")
    stream.createOrReplaceTempView(name)
    return _sources(spark, sf, events=name)


@query
def daily_summary_stream(spark, sf):
    rows = etl.cleansed(_event_stream(spark, sf, "opsflow_event_stream"), WATERMARK, RUN_TS)
    rows = rows.toDF(*[c.lower() for c in rows.columns])
    root = work_path(spark, "summary")
    path = posixpath.join(root, "partials")
    summary_stream.run_summary_stream(rows, path, posixpath.join(root, "checkpoint")).awaitTermination()
    return _summary_view(summary.read_state(spark, path))


@query
def daily_summary_windowed(spark, sf):
    """Event-time windows, the days still open at the end of the input included."""
    rows = etl.cleansed(_event_stream(spark, sf, "opsflow_window_stream"), WATERMARK, RUN_TS)
    windows = summary_stream.windowed_summary(rows.toDF(*[c.lower() for c in rows.columns]), "1 day")
    root = work_path(spark, "windowed")
    path = posixpath.join(root, "out")
    summary_stream.run_windowed_stream(windows, path, posixpath.join(root, "checkpoint")).awaitTermination()
    return _as_doubles(summary_stream.read_windowed(spark, path, windows.schema))


@query
def etl_stream(spark, sf):
    root = work_path(spark, "etl-stream")
    sources, target = _event_stream(spark, sf, "opsflow_load_stream"), posixpath.join(root, "target")
    load.run_load_stream(sources, target, posixpath.join(root, "checkpoint"), RUN_TS, WATERMARK).awaitTermination()
    return _as_doubles(spark.read.schema(STAGED_INVENTORY).parquet(target).select(*STAGED_INVENTORY.names))


# --- monthly close, top row, JSON lines, masking ----------------------------


def _close_values(rows):
    return rows.withColumns({c: F.col(c).cast("double") for c in close.VALUES})


@query
def monthly_close(spark, sf):
    return _close_values(close.close_rows(view(spark, sf, "fx_movements"), 2024, 1))


@query
def monthly_close_upsert(spark, sf):
    """A first close of the month's first half, then the close of the whole month over it."""
    root = work_path(spark, "close")
    staging, table = posixpath.join(root, "staging"), posixpath.join(root, "close")
    moves = view(spark, sf, "fx_movements")
    half = moves.where(F.col("transaction_date") < F.lit(MID_WATERMARK).cast("timestamp_ntz"))
    close.monthly_close(spark, half, 2024, 1, staging, table, MID_WATERMARK)
    close.monthly_close(spark, moves, 2024, 1, staging, table, RUN_TS)
    rows = spark.read.schema(MONTHLY_CLOSE).parquet(table).select(*MONTHLY_CLOSE.names)
    return _close_values(rows)


@query
def close_insert_select(spark, sf):
    """A close table created in the catalog if it is missing, and filled by INSERT … SELECT, one warehouse pair at a time."""
    name, path = _table_name("close"), work_path(spark, "close-table")
    rows = close.close_rows(view(spark, sf, "fx_movements"), 2024, 1).withColumn("updated_at", F.lit(RUN_TS).cast("timestamp_ntz"))
    early = F.col("warehouse_id").isin("WH-01", "WH-02")
    for part in (rows.where(early), rows.where(~early)):
        create_if_missing(spark, name, MONTHLY_CLOSE, path)
        insert_select(conform(part, MONTHLY_CLOSE), name)
    spark.sql(f"DROP TABLE {name}")  # the entry, not the files
    return _close_values(spark.read.schema(MONTHLY_CLOSE).parquet(path))


@query
def close_sql_script(spark, sf):
    """The close as one SQL script, run for half the month, for a month without movements, and for the whole month; its last message."""
    names = [_table_name(label) for label in ("script_close", "script_staging", "script_merged")]
    moves = view(spark, sf, "fx_movements")
    folder, source = work_path(spark, "close-script"), _table_name("script_movements")
    close_script.create_close_tables(spark, *names, folder)
    half = moves.where(F.col("transaction_date") < F.lit(MID_WATERMARK).cast("timestamp_ntz"))
    for rows, month, stamp in ((half, 1, MID_WATERMARK), (half, 6, RUN_TS), (moves, 1, RUN_TS)):
        rows.createOrReplaceTempView(source)
        message = close_script.run_close_script(spark, source, *names, 2024, month, stamp)
    table = spark.read.schema(MONTHLY_CLOSE).parquet(posixpath.join(folder, names[0])).select(*MONTHLY_CLOSE.names)
    closed = _close_values(table).withColumn("message", F.lit(message))
    spark.catalog.dropTempView(source)
    for name in names:
        spark.sql(f"DROP TABLE {name}")  # the entries, not the files
    return closed


@query
def top_invoice_per_supplier(spark, sf):
    order = [F.col("gross_amount").desc_nulls_first(), F.col("invoice_number"), F.col("net_amount")]
    rows = ranking.top_k_per_group(view(spark, sf, "fx_gl_invoices"), ["vendor_id"], order, 1)
    return rows.select(
        "vendor_id",
        "invoice_number",
        F.col("gross_amount").cast("double").alias("gross_amount"),
        F.col("rn").cast("bigint").alias("rn"),
    )


def _lines(rows):
    return rows.withColumn("quantity", F.col("quantity").cast("bigint"))


@query
def order_line_flatten(spark, sf):
    return _lines(flatten.flatten_lines(view(spark, sf, "fx_order_lines")))


@query
def order_line_flatten_variant(spark, sf):
    """Documents that are arrays, objects of line objects, empty, missing or broken."""
    return _lines(flatten.flatten_lines(view(spark, sf, "fx_order_documents")))


@query
def mask_vendor_email(spark, sf):
    policy = masking.email_policy({"DATA_ADMIN", "FINANCE_ANALYST"})
    vendors = view(spark, sf, "fx_vendors").withColumn("clear_email", F.col("contact_email"))
    hidden = masking.masked(vendors, {"contact_email": policy}, "REPORT_READER")
    return masking.masked(hidden, {"clear_email": policy}, "DATA_ADMIN")


@query
def mask_by_session_role(spark, sf):
    """One view of the vendors, read under two roles that the session takes one after the other."""
    path, shown, mask = work_path(spark, "vendors"), _table_name("governed"), _table_name("mask")
    vendors = view(spark, sf, "fx_vendors").select("vendor_id", "contact_email")
    vendors.write.parquet(path)
    masking.declare_role(spark)
    masking.create_email_mask(spark, mask, {"DATA_ADMIN", "FINANCE_ANALYST"})
    masking.governed_view(spark, shown, f"parquet.`{path}`", vendors.columns, {"contact_email": mask})
    seen = []
    for role in ("REPORT_READER", "DATA_ADMIN"):
        masking.set_role(spark, role)
        seen.append(staged(spark.table(shown).withColumn("role", F.lit(role)), "seen"))
    spark.catalog.dropTempView(shown)
    return seen[0].unionByName(seen[1])


# --- reports and layout ----------------------------------------------------

SNAPSHOT_RUN = RunContext.at(datetime(2024, 1, 30, 7))
SCORE_RUN = RunContext.at(datetime(2001, 8, 1, 8))


def _weekly(card, sunday):
    """Scorecard rows of one week; the Sunday is written out, so that the extract's own date can be wrong."""
    return card.withColumn("week_ending", F.lit(sunday).cast("date"))


@query
def report_inventory_summary(spark, sf):
    tables = {"inventory_snapshot": view(spark, sf, "fx_snapshot")}
    return reports.execute(spark, reports.CATALOGUE[0], tables, SNAPSHOT_RUN)


@query
def report_sql_text(spark, sf):
    """A report kept as SQL text, with a named date token and a named value."""
    report = reports.Report(
        "Low Stock",
        """SELECT warehouse_name, category, count(DISTINCT sku_id) AS skus_below_reorder FROM {inventory_snapshot}
           WHERE snapshot_date = CAST(:snapshot_date AS DATE) AND quantity_on_hand < reorder_point AND category <> :left_out
           GROUP BY warehouse_name, category""",
        {"snapshot_date": "today", "left_out": "ECONOMY ANODIZED STEEL"},
    )
    return reports.execute(spark, report, {"inventory_snapshot": view(spark, sf, "fx_snapshot")}, SNAPSHOT_RUN)


@query
def movements_by_code(spark, sf):
    """Movements counted by a literal table of type codes; a code that no movement has counts zero."""
    codes = literal_table(spark, [("RCPT", "receipt"), ("SHIP", "shipment"), ("TRFR", "transfer")], "code string, meaning string")
    moves = view(spark, sf, "fx_movements").select(F.upper(F.trim("transaction_type")).alias("code"), "transaction_id")
    return codes.join(moves, "code", "left").groupBy("code", "meaning").agg(F.count("transaction_id").alias("movements"))


@query
def report_scorecard(spark, sf):
    tables = {"supplier_scorecard_weekly": _weekly(supplier_scorecard(spark, sf), "2001-07-29")}
    return reports.execute(spark, reports.CATALOGUE[1], tables, SCORE_RUN)


@query
def report_manifest(spark, sf):
    """Runs the whole catalogue on one day and lists its deliveries."""
    root = work_path(spark, "reports")
    log = posixpath.join(root, "log")
    weekly = _weekly(supplier_scorecard(spark, sf), "2024-01-28")
    tables = {"inventory_snapshot": view(spark, sf, "fx_snapshot"), "supplier_scorecard_weekly": weekly}
    reports.run_catalogue(spark, tables, SNAPSHOT_RUN, posixpath.join(root, "out"), log)
    return delivery_manifest(spark.read.schema(DELIVERY_LOG).parquet(log))


@query
def report_stored_output(spark, sf):
    """The rows a report run has stored, read back."""
    root = work_path(spark, "report-output")
    tables = {"inventory_snapshot": view(spark, sf, "fx_snapshot")}
    reports.run_report(spark, reports.CATALOGUE[0], tables, SNAPSHOT_RUN, root, posixpath.join(root, "log"))
    return spark.read.parquet(reports.output_path(root, reports.CATALOGUE[0], SNAPSHOT_RUN))


@query
def report_no_data(spark, sf):
    """A report of a day with rows and of one without: what is logged, and whether anything is stored."""
    root, outcome = work_path(spark, "report-empty"), []
    tables = {"inventory_snapshot": view(spark, sf, "fx_snapshot")}
    for run in (SNAPSHOT_RUN, RunContext.at(datetime(2030, 1, 1))):
        status = reports.run_report(spark, reports.CATALOGUE[0], tables, run, root, posixpath.join(root, "log"))
        stored = path_exists(spark, reports.output_path(root, reports.CATALOGUE[0], run))
        outcome.append((run.as_of, status, stored))
    return spark.createDataFrame(outcome, "run_date date, status string, stored boolean")


@query
def layout_depth(spark, sf):
    """How many customers' spans of orders cover the first order of each customer."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    day = F.col("o_orderdate").cast("date")
    spans = orders.groupBy(F.col("o_custkey").cast("string").alias("customer")).agg(
        F.count("*").alias("row_count"), F.min(day).alias("low"), F.max(day).alias("high")
    )
    depth = intervals.with_overlap(spans, "low", "high")
    return depth.select("customer", "row_count", F.col("depth").cast("bigint"))


@query
def layout_clustered_rows(spark, sf):
    """A table written in clusters keeps every row, its files follow each other in key order, and rows lie sorted in them."""
    path = work_path(spark, "clustered")
    rows, key = view(spark, sf, "fx_inventory"), ["transaction_date", "warehouse_id", "sku_id"]
    layout.write_clustered(rows, path, key[:2], spread_by=key[2:])
    written = spark.read.schema(rows.schema).parquet(path)
    files = layout.files_in_order(written, key)
    # One row group of a sorted file after the other: the key at a row never falls behind the one before it.
    placed = written.select(F.input_file_name().alias("file"), F.col("_metadata.row_index").alias("at"), F.struct(*key).alias("key"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    fallen = placed.withColumn("fell", F.col("key") < before).agg(F.coalesce(F.bool_or("fell"), F.lit(False)).alias("fell"))
    return written.groupBy("transaction_date", "warehouse_id").agg(
        F.count("*").alias("row_count"), F.sum("quantity_on_hand").cast("double").alias("quantity_on_hand")
    ).withColumns({"files_in_order": files.select("in_order").scalar(), "rows_in_order": ~fallen.scalar()})


@query
def layout_bucketed_join(spark, sf):
    """Orders and their lines, bucketed alike by order: joined and grouped where they lie."""
    names = {n: _table_name(n) for n in ("orders", "lines")}
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("order_key"), "o_custkey", "o_orderstatus")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_orderkey").alias("order_key"), "l_quantity", "l_linenumber")
    # Both tables need the same number of buckets; it follows from the rows, so that a task's bucket does not grow with them.
    buckets = layout.buckets_for(orders, lines)
    for name, rows in (("orders", orders), ("lines", lines)):
        layout.write_bucketed(rows, names[name], buckets, ["order_key"], path=work_path(spark, f"bucketed-{name}"))
    joined = layout.join_bucketed(spark.table(names["orders"]), spark.table(names["lines"]), ["order_key"])
    result = joined.groupBy("order_key", "o_custkey", "o_orderstatus").agg(
        F.count("*").alias("line_count"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity")
    )
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")  # the entries, not the files
    return result
