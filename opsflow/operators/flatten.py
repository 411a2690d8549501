"""JSON line items to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def flatten_lines(orders: DataFrame, key: str = "order_id", json_column: str = "line_items_json") -> DataFrame:
    """One row per element of an array, or per value of an object; empty, NULL and unreadable text gives none.

    Quantities round half-up to whole numbers and a missing field is NULL.
    """
    parsed = orders.select(key, F.try_parse_json(json_column).alias("_doc"))
    items = parsed.lateralJoin(
        parsed.sparkSession.tvf.variant_explode(F.col("_doc").outer()).select(F.col("value").alias("_item"))
    )

    def field(name: str, kind: str):
        return F.try_variant_get("_item", f"$.{name}", kind)

    return items.select(
        key,
        field("sku_id", "string").alias("sku_id"),
        F.round(field("quantity", "decimal(38,6)"), 0).cast("decimal(38,0)").alias("quantity"),
        field("unit_price", "double").alias("unit_price"),
    )
