"""The monthly close as one SQL script: aggregate and stage, merge beside the table, swap the period in, report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from opsflow.context import month_bounds, period_label
from opsflow.schemas import MONTHLY_CLOSE

# Table names come in by IDENTIFIER and values by name, so no text is pasted in. A period is
# merged in a table of its own first, since a table cannot be overwritten while it is read;
# the close table is written by dynamic overwrite, so other periods stay as they are.
SCRIPT = """
BEGIN
  DECLARE period STRING DEFAULT :period;
  DECLARE closed_at TIMESTAMP_NTZ DEFAULT :run_ts;
  DECLARE staged_rows BIGINT DEFAULT 0;
  DECLARE EXIT HANDLER FOR SQLEXCEPTION
  BEGIN
    SELECT false AS completed, concat('Monthly close for ', period, ' failed.') AS message;
  END;

  INSERT OVERWRITE IDENTIFIER(:staging)
  SELECT CAST(sku_id AS STRING), CAST(warehouse_id AS STRING), period,
         CAST(sum(quantity) AS DECIMAL(38,4)), CAST(sum(quantity * unit_cost) AS DECIMAL(38,4)), closed_at
  FROM IDENTIFIER(:movements)
  WHERE transaction_date >= :first_instant AND transaction_date < :next_instant
  GROUP BY sku_id, warehouse_id;

  SET staged_rows = (SELECT count(*) FROM IDENTIFIER(:staging));

  IF staged_rows > 0 THEN
    INSERT OVERWRITE IDENTIFIER(:merged)
    SELECT coalesce(s.sku_id, t.sku_id), coalesce(s.warehouse_id, t.warehouse_id),
           CASE WHEN s.closed IS NULL THEN t.net_qty ELSE s.net_qty END,
           CASE WHEN s.closed IS NULL THEN t.total_value ELSE s.total_value END,
           CASE WHEN s.closed IS NULL THEN t.updated_at ELSE s.updated_at END, period
    FROM (SELECT *, true AS closed FROM IDENTIFIER(:staging)) AS s
    FULL OUTER JOIN (SELECT * FROM IDENTIFIER(:target) WHERE close_period = period) AS t
      ON s.sku_id = t.sku_id AND s.warehouse_id = t.warehouse_id;

    INSERT OVERWRITE IDENTIFIER(:target)
    SELECT sku_id, warehouse_id, net_qty, total_value, updated_at, close_period FROM IDENTIFIER(:merged);
  END IF;

  SELECT true AS completed, concat('Monthly close for ', period, ' completed successfully.') AS message;
END
"""


def create_close_tables(spark: SparkSession, target: str, staging: str, merged: str, folder: str) -> None:
    """Catalog tables of the close below ``folder``, if they are missing; the target is partitioned by period."""
    columns = {f.name: f.dataType.simpleString() for f in MONTHLY_CLOSE}
    tail = [c for c in columns if c != "close_period"] + ["close_period"]
    for name, order, layout in (
        (staging, list(columns), ""),
        (merged, tail, ""),
        (target, tail, "OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (close_period)"),
    ):
        listed = ", ".join(f"{c} {columns[c]}" for c in order)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({listed}) USING parquet {layout} LOCATION '{folder}/{name}'")


def run_close_script(
    spark: SparkSession, movements: str, target: str, staging: str, merged: str, year: int, month: int, run_ts: datetime
) -> str:
    """Closes one month of the table or view ``movements`` and returns the script's message; a failed close raises it."""
    first, following = month_bounds(year, month)
    answer = spark.sql(SCRIPT, args={
        "period": period_label(year, month), "run_ts": run_ts, "first_instant": first, "next_instant": following,
        "movements": movements, "target": target, "staging": staging, "merged": merged,
    }).first()
    if not answer.completed:
        raise RuntimeError(answer.message)
    return answer.message
