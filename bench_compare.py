"""Times two design choices against their plain forms and prints one JSON line.

* the daily summary: adding one day to a stored state against recomputing it;
* the data-quality suite: one fused aggregate against one pass per rule.
"""

from __future__ import annotations

import itertools
import json
import os
import time

from pyspark.sql import functions as F

from opsflow.operators import quality as dq
from opsflow.plans import etl, summary
from opsflow.registry import RUN_TS, TYPE_CODES, WAREHOUSE_CODES, WATERMARK, _sources
from opsflow.session import build_session, staged, work_path
from opsflow.sources.views import view


def seconds(action, repeat: int = 3) -> float:
    best = None
    for _ in range(repeat):
        start = time.perf_counter()
        action()
        took = time.perf_counter() - start
        best = took if best is None else min(best, took)
    return round(best, 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "opsflow-bench-compare",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    moves = etl.cleansed(_sources(spark, sf_dir), WATERMARK, RUN_TS)
    moves = staged(moves.toDF(*[c.lower() for c in moves.columns]), "bench-moves")
    last = F.to_date("transaction_date") == F.lit("2024-01-30").cast("date")
    stored, batch = work_path(spark, "bench-state"), itertools.count()
    summary.fold(stored, moves.where(~last), F.lit(next(batch)), "day")

    raw = staged(view(spark, sf_dir, "fx_movements"), "bench-raw")
    rules = [
        dq.row_count_threshold(1),
        dq.not_null("transaction_id"),
        dq.not_null("sku_id"),
        dq.not_null("warehouse_id"),
        dq.in_range("quantity", 0, 100_000),
        dq.in_range("unit_cost", 0, 100),
        dq.matches_regex("warehouse_id", "WH-"),
        dq.referential_integrity("warehouse_id", {*WAREHOUSE_CODES, "WH-04"}),
        dq.referential_integrity("transaction_type", {*TYPE_CODES, "misc "}),
        dq.freshness("transaction_date", RUN_TS, 48),
    ]

    print(
        json.dumps(
            {
                "summary_full": seconds(lambda: run(summary.daily_summary(moves))),
                "summary_one_day_added": seconds(
                    lambda: summary.fold(stored, moves.where(last), F.lit(next(batch)), "day")
                ),
                "quality_fused": seconds(lambda: dq.run_suite(raw, "moves", rules)),
                "quality_rule_by_rule": seconds(lambda: [dq.run_suite(raw, "moves", [r]) for r in rules]),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
