"""Report catalogue: parameterised queries, stored output, delivery log."""

from __future__ import annotations

import logging
import posixpath
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsflow.context import RunContext, resolve_date_token
from opsflow.session import job_scope, staged
from opsflow.sources.logs import FAILURE, NO_DATA, SUCCESS, append_delivery

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Report:
    """A named query.

    ``query`` is SQL with ``{table}`` placeholders and ``:name`` markers, or a
    function of (tables, parameters). ``schedule`` is kept as text for the
    scheduler that starts the run.
    """

    name: str
    query: str | Callable[[Mapping[str, DataFrame], Mapping[str, str]], DataFrame]
    params: Mapping[str, str] = field(default_factory=dict)
    recipients: Sequence[str] = ()
    schedule: str = ""

    @property
    def slug(self) -> str:
        return "_".join(self.name.lower().split())


def inventory_summary(tables: Mapping[str, DataFrame], params: Mapping[str, str]) -> DataFrame:
    """SKUs, quantity, value and rows below the reorder point per warehouse and category of one day."""
    stock, on_hand = tables["inventory_snapshot"], F.col("quantity_on_hand")
    per_sku = (
        stock.where(F.col("snapshot_date") == F.lit(params["snapshot_date"]).cast("date"))
        .groupBy("warehouse_name", "category", "sku_id")
        .agg(
            F.sum(on_hand).alias("qty"),
            F.sum(on_hand * F.col("unit_cost")).alias("value"),
            F.count_if(on_hand < F.col("reorder_point")).alias("below"),
        )
    )
    # One row per SKU by now, so counting rows counts SKUs.
    return (
        per_sku.groupBy("warehouse_name", "category")
        .agg(
            F.count("sku_id").alias("total_skus"),
            F.sum("qty").cast("double").alias("total_qty_on_hand"),
            F.sum("value").cast("double").alias("inventory_value_usd"),
            F.sum("below").alias("skus_below_reorder"),
        )
        .orderBy(F.col("inventory_value_usd").desc_nulls_first(), "warehouse_name", "category")
    )


def scorecard_extract(tables: Mapping[str, DataFrame], params: Mapping[str, str]) -> DataFrame:
    """The weekly card's rows of one closing day, best score first."""
    card = tables["supplier_scorecard_weekly"].where(F.col("week_ending") == F.lit(params["week_ending"]).cast("date"))
    shown = card.select(
        "supplier_name", "on_time_delivery_pct", "fill_rate_pct", "defect_rate_pct", "composite_score", "supplier_status"
    )
    return shown.orderBy(F.col("composite_score").desc_nulls_first(), "supplier_name")


# Names, parameters and schedules of the catalogue.
CATALOGUE: tuple[Report, ...] = (
    Report(
        "Daily Inventory Summary",
        inventory_summary,
        {"snapshot_date": "today"},
        ("procurement@example.com", "operations@example.com"),
        "0 7 * * 1-5",
    ),
    Report(
        "Weekly Supplier Scorecard",
        scorecard_extract,
        {"week_ending": "last_sunday"},
        ("supply-chain@example.com",),
        "0 8 * * 1",
    ),
)


def resolved_params(params: Mapping[str, str], run: RunContext) -> dict[str, str]:
    return {name: resolve_date_token(value, run.as_of) for name, value in params.items()}


def execute(spark: SparkSession, report: Report, tables: Mapping[str, DataFrame], run: RunContext) -> DataFrame:
    """The report's rows; parameters are bound as values, never pasted into the text."""
    params = resolved_params(report.params, run)
    if callable(report.query):
        return report.query(tables, params)
    used = {name: df for name, df in tables.items() if "{" + name + "}" in report.query}
    return spark.sql(report.query, args=params, **used)


def output_path(root: str, report: Report, run: RunContext) -> str:
    return posixpath.join(root, f"report={report.slug}", f"run_date={run.as_of.isoformat()}")


def run_report(
    spark: SparkSession,
    report: Report,
    tables: Mapping[str, DataFrame],
    run: RunContext,
    root: str,
    log_path: str,
) -> str:
    """Runs one report, stores its rows and logs the delivery; a failure is logged and raised.

    A report without rows is logged as such and stores nothing; what an earlier run of the
    day has stored stays. The query runs once, into the working folder.
    """
    try:
        with job_scope(spark):
            rows = staged(execute(spark, report, tables, run), report.slug)
            count = rows.count()
            if count:
                rows.write.mode("overwrite").parquet(output_path(root, report, run))
    except Exception as error:
        append_delivery(spark, log_path, report.name, run.run_ts, FAILURE, 0, report.recipients, str(error))
        raise
    status = SUCCESS if count else NO_DATA
    append_delivery(spark, log_path, report.name, run.run_ts, status, count, report.recipients)
    return status


def run_catalogue(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    run: RunContext,
    root: str,
    log_path: str,
    catalogue: Sequence[Report] = CATALOGUE,
) -> dict[str, str]:
    """Runs every report; one that fails does not stop the others."""
    outcome = {}
    for report in catalogue:
        try:
            outcome[report.name] = run_report(spark, report, tables, run, root, log_path)
        except Exception:
            log.exception("report %s failed", report.name)
            outcome[report.name] = FAILURE
    return outcome
