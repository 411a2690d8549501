"""Declared schemas of the tables the jobs write or append to."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, INT, LONG, DAY, STAMP = StringType(), IntegerType(), LongType(), DateType(), TimestampNTZType()
AMOUNT, MONEY, TOTAL = DecimalType(18, 4), DecimalType(18, 2), DecimalType(38, 4)


def table(**columns: DataType) -> StructType:
    """Schema from column names and types; built without a running session."""
    return StructType([StructField(name, kind) for name, kind in columns.items()])


STAGED_INVENTORY = table(
    TRANSACTION_ID=TEXT,
    SKU_ID=TEXT,
    WAREHOUSE_ID=TEXT,
    TRANSACTION_TYPE=TEXT,
    QUANTITY=AMOUNT,
    SIGNED_QUANTITY=AMOUNT,
    UNIT_COST=AMOUNT,
    EXTENDED_COST=MONEY,
    TRANSACTION_DATE=STAMP,
    TRANSACTION_YEAR=INT,
    TRANSACTION_MONTH=INT,
    TRANSACTION_WEEK=INT,
    REFERENCE_NUMBER=TEXT,
    SKU_NAME=TEXT,
    CATEGORY=TEXT,
    UNIT_OF_MEASURE=TEXT,
    WAREHOUSE_NAME=TEXT,
    REGION=TEXT,
    CREATED_BY=TEXT,
    MODIFIED_DATE=STAMP,
    LOAD_TIMESTAMP=STAMP,
    ROW_HASH=TEXT,
)

RUN_LOG = table(pipeline_name=TEXT, load_timestamp=STAMP, rows_loaded=LONG, status=TEXT, error_message=TEXT)

DELIVERY_LOG = table(
    logged_at=STAMP, report_name=TEXT, status=TEXT, row_count=LONG, recipients=TEXT, error=TEXT
)

FEED_OFFSETS = table(consumer=TEXT, commit_id=LONG, moved_at=STAMP)

MERGE_MARKS = table(mark=LONG, merged_at=STAMP)

INVENTORY_FACT = table(
    transaction_id=LONG,
    sku_id=LONG,
    warehouse_id=TEXT,
    quantity=AMOUNT,
    unit_cost=AMOUNT,
    transaction_date=STAMP,
    last_updated_ts=STAMP,
)

MONTHLY_CLOSE = table(
    sku_id=TEXT, warehouse_id=TEXT, close_period=TEXT, net_qty=TOTAL, total_value=TOTAL, updated_at=STAMP
)

SUMMARY_STATE = table(
    snapshot_day=DAY,
    warehouse_id=TEXT,
    sku_id=TEXT,
    category=TEXT,
    total_received=TOTAL,
    received_count=LONG,
    total_shipped=TOTAL,
    shipped_count=LONG,
    cost_sum=TOTAL,
    cost_count=LONG,
    row_count=LONG,
    applied=LONG,
    period=TEXT,
)

SUMMARY_FEED = table(feed=TEXT)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` cast to ``schema``, column by column and in its order; a missing column becomes NULL."""
    have = {c.upper(): c for c in df.columns}
    return df.select(
        [
            (F.col(have[f.name.upper()]) if f.name.upper() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
