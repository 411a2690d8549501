"""Incremental load of warehouse movements: extract, cleanse, append, log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StringType

from opsflow.context import RunContext
from opsflow.functions.dates import TEXT_FORMATS, naive, parse_timestamp
from opsflow.functions.numeric import round_half_even
from opsflow.functions.text import map_code, row_hash, title_case
from opsflow.operators.joins import lookup
from opsflow.schemas import STAGED_INVENTORY, conform
from opsflow.session import job_scope, staged
from opsflow.sources.logs import FAILURE, SUCCESS, append_run, last_success
from opsflow.sources.tables import append_table, observed_rows

PIPELINE = "WMS_INVENTORY_ETL"
LOOKBACK_DAYS = 90  # the reach of a load without a stored watermark, if the caller names none

# Source column names, type codes and the types that reduce stock.
MOVEMENT_COLUMNS = {
    "TransactionID": "transaction_id",
    "SKU_ID": "sku_id",
    "WarehouseID": "warehouse_id",
    "TransactionType": "transaction_type",
    "Quantity": "quantity",
    "UnitCost": "unit_cost",
    "TransactionDate": "transaction_date",
    "ReferenceNumber": "reference_number",
    "CreatedBy": "created_by",
    "ModifiedDate": "modified_date",
    "TransactionStatus": "transaction_status",
}
SKU_COLUMNS = {"SKU_ID": "sku_id", "SKUName": "sku_name", "Category": "category", "UOM": "unit_of_measure"}
WAREHOUSE_COLUMNS = {"WarehouseID": "warehouse_id", "WarehouseName": "warehouse_name", "Region": "region"}
TYPE_CODES = {
    "RCPT": "RECEIPT",
    "SHIP": "SHIPMENT",
    "ADJ+": "ADJUSTMENT_POSITIVE",
    "ADJ-": "ADJUSTMENT_NEGATIVE",
    "TRFR": "TRANSFER",
    "RTN": "RETURN",
}
OUTBOUND_TYPES = ("SHIPMENT", "ADJUSTMENT_NEGATIVE")
TEXT_COLUMNS = ("SKU_NAME", "CATEGORY", "WAREHOUSE_NAME", "REGION")
HASHED_COLUMNS = ("TRANSACTION_ID", "SKU_ID", "WAREHOUSE_ID", "TRANSACTION_DATE", "QUANTITY")


@dataclass(frozen=True)
class Sources:
    """The operational tables, under their snake_case column names."""

    movements: DataFrame
    skus: DataFrame
    warehouses: DataFrame


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Projection of an operational table to this library's column names."""
    return df.select([F.col(old).alias(new) for old, new in names.items() if old in df.columns])


def modified_since(movements: DataFrame, watermark: datetime | None) -> DataFrame:
    """Rows at or after the watermark (None: all) that are not void; a NULL status drops out."""
    live = movements.where(F.col("transaction_status") != "VOIDED")
    return live if watermark is None else live.where(F.col("modified_date") >= naive(watermark))


def clean_names(df: DataFrame) -> DataFrame:
    """Name columns trimmed and in title case."""
    return df.withColumns({c: title_case(F.col(c)) for c in df.columns if c.upper() in TEXT_COLUMNS})


def extract(sources: Sources, watermark: datetime | None, tidy: bool = False) -> DataFrame:
    """Changed movements with SKU and warehouse names; movements without either record drop out.

    ``tidy`` cleans the names in the two dimension tables, once per SKU and
    warehouse, so that :func:`transform` need not clean them once per movement.
    """
    rows = modified_since(sources.movements, watermark).drop("transaction_status")
    skus = sources.skus.select(*SKU_COLUMNS.values())
    warehouses = sources.warehouses.select(*WAREHOUSE_COLUMNS.values())
    if tidy:
        skus, warehouses = clean_names(skus), clean_names(warehouses)
    return lookup(lookup(rows, skus, {"sku_id": "sku_id"}), warehouses, {"warehouse_id": "warehouse_id"})


def signed_quantity(kind: Column, quantity: Column) -> Column:
    return F.when(kind.isin(*OUTBOUND_TYPES), -F.abs(quantity)).otherwise(F.abs(quantity))


def readable(raw: DataFrame, formats: Sequence[str] = TEXT_FORMATS) -> DataFrame:
    """``raw`` with upper-case names, dates and amounts in their types, and all columns of the staging table's input.

    Text dates are read by ``formats`` in turn.
    """
    upper = raw.toDF(*[c.upper() for c in raw.columns])
    kinds = {f.name: f.dataType for f in upper.schema}
    for name in STAGED_INVENTORY.names:
        if name in ("REFERENCE_NUMBER", "CREATED_BY", "MODIFIED_DATE") and name not in kinds:
            upper = upper.withColumn(name, F.lit(None).cast("string"))
    return upper.withColumns(
        {
            "TRANSACTION_DATE": parse_timestamp(
                F.col("TRANSACTION_DATE"), isinstance(kinds["TRANSACTION_DATE"], StringType), formats
            ),
            "MODIFIED_DATE": parse_timestamp(
                F.col("MODIFIED_DATE"), isinstance(kinds.get("MODIFIED_DATE"), StringType), formats
            ),
            "QUANTITY": F.col("QUANTITY").cast("decimal(18,4)"),
            "UNIT_COST": F.col("UNIT_COST").cast("decimal(18,4)"),
        }
    )


def _unusable() -> Column:
    return F.col("QUANTITY").isNull() | F.col("TRANSACTION_DATE").isNull()


def quarantined(raw: DataFrame, formats: Sequence[str] = TEXT_FORMATS) -> DataFrame:
    """The rows that :func:`transform` leaves out, as they came, with the columns that could not be read."""
    packed = raw.withColumn("_raw", F.struct(*raw.columns))
    parsed = readable(packed, formats)
    unread = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ("QUANTITY", "TRANSACTION_DATE")]), lambda c: c.isNotNull()
    )
    return parsed.where(_unusable()).select("_RAW.*", F.array_join(unread, ",").alias("unreadable"))


def transform(
    raw: DataFrame,
    run_ts: datetime,
    dropped: Observation | None = None,
    tidy: bool = False,
    formats: Sequence[str] = TEXT_FORMATS,
) -> DataFrame:
    """Cleansed rows in the staging table's columns.

    ``tidy`` says that the names are clean already. ``dropped`` receives, as ``rows``, how many
    rows had no quantity or no readable date; :func:`quarantined` gives those rows.
    """
    parsed = readable(raw, formats)
    if dropped is not None:
        parsed = parsed.observe(dropped, F.count_if(_unusable()).alias("rows"))
    when, quantity = F.col("TRANSACTION_DATE"), F.col("QUANTITY")
    derived = parsed.na.drop(subset=["QUANTITY", "TRANSACTION_DATE"]).withColumns(
        {
            "LOAD_TIMESTAMP": naive(run_ts),
            "TRANSACTION_TYPE": map_code(F.col("TRANSACTION_TYPE"), TYPE_CODES),
        }
    ).withColumns(
        {
            "SIGNED_QUANTITY": signed_quantity(F.col("TRANSACTION_TYPE"), quantity),
            "EXTENDED_COST": round_half_even(quantity * F.col("UNIT_COST"), 2, "decimal(18,2)"),
            "TRANSACTION_YEAR": F.year(when),
            "TRANSACTION_MONTH": F.month(when),
            "TRANSACTION_WEEK": F.weekofyear(when),
            "ROW_HASH": row_hash([F.col(c) for c in HASHED_COLUMNS]),
        }
    )
    return conform(derived if tidy else clean_names(derived), STAGED_INVENTORY)


def cleansed(
    sources: Sources, watermark: datetime | None, run_ts: datetime, dropped: Observation | None = None
) -> DataFrame:
    """Extract and transform in one plan, names cleaned before the joins."""
    return transform(extract(sources, watermark, tidy=True), run_ts, dropped, tidy=True)


def not_yet_loaded(rows: DataFrame, target: DataFrame, watermark: datetime) -> DataFrame:
    """Rows of which the target does not hold this very version.

    Only rows modified since the watermark can be read twice, so the target is
    scanned from there on and not as a whole. Its partitions are months of the
    transaction; a row's hash holds that date, so only the months among the new
    rows are opened (pruned at run time by the semi join on the partition columns).
    """
    keys, months = ["ROW_HASH", "MODIFIED_DATE"], ["TRANSACTION_YEAR", "TRANSACTION_MONTH"]
    recent = target.where(F.col("MODIFIED_DATE") >= naive(watermark)).join(
        rows.select(*months).distinct(), months, "left_semi"
    )
    return rows.join(recent.select(*keys), keys, "left_anti")


@dataclass(frozen=True)
class RunResult:
    watermark: datetime | None
    rows_loaded: int
    rows_dropped: int


def run_pipeline(
    sources: Sources,
    target_path: str,
    log_path: str,
    run: RunContext,
    full_load: bool = False,
    skip_loaded: bool = False,
    pipeline: str = PIPELINE,
    lookback_days: int | None = LOOKBACK_DAYS,
) -> RunResult:
    """Extract, transform and append as one Spark job (with ``skip_loaded`` the extract is stored first), then one log row.

    A full load, and a first one, reaches ``lookback_days`` back; None loads everything.

    The loaded count comes from the writing tasks. The dropped count is taken
    before the shuffle and is for information: tasks repeated after a lost
    executor count again, and a branch skipped as empty is not counted. A run without new rows logs
    SUCCESS with 0; a failed run logs FAILURE and raises. The run's own time is
    the next watermark, so rows changed while it runs are read again, not missed;
    ``skip_loaded`` leaves out the rows that such a second reading finds loaded.
    """
    spark = sources.movements.sparkSession
    previous = None if full_load else last_success(spark, log_path, pipeline)
    watermark = previous
    if previous is None and lookback_days is not None:
        watermark = run.run_ts - timedelta(days=lookback_days)
    try:
        dropped = Observation()
        rows = cleansed(sources, watermark, run.run_ts, dropped)
        with job_scope(spark):
            if skip_loaded and previous is not None:
                # Stored, since both its months and its rows are read.
                rows = not_yet_loaded(staged(rows, "extracted"), spark.read.schema(STAGED_INVENTORY).parquet(target_path), watermark)
            loaded = append_table(
                rows,
                target_path,
                STAGED_INVENTORY,
                partition_by=["TRANSACTION_YEAR", "TRANSACTION_MONTH"],
                cluster_by=["WAREHOUSE_ID"],
            )
    except Exception as error:
        append_run(spark, log_path, pipeline, run.run_ts, 0, FAILURE, str(error))
        raise
    append_run(spark, log_path, pipeline, run.run_ts, loaded, SUCCESS)
    return RunResult(watermark, loaded, observed_rows(dropped))
