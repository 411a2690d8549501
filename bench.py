"""Times the registered queries and prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` an optional comma-separated choice. A query's time is the median of up to
three runs: every query runs once, then all run again while ``BENCH_SECONDS`` (600) have not
passed. ``spread`` gives the slowest run over the fastest of each query that ran more than
once, so that noise can be told from a regression.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

from opsflow.registry import QUERIES
from opsflow.session import build_session, job_scope

WARM_UP = "supplier_quality"


def timed(spark, sf_dir: str, name: str) -> float:
    with job_scope(spark):
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "opsflow-bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="opsflow-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, sf_dir, WARM_UP)
    limit, began = float(os.environ.get("BENCH_SECONDS", "600")), time.perf_counter()
    runs: dict[str, list[float]] = {name: [] for name in (chosen.split(",") if chosen else QUERIES)}
    for turn in range(3):
        for name, took in runs.items():
            if not turn or time.perf_counter() - began < limit:
                took.append(timed(spark, sf_dir, name))
                print(f"{name}: {took[-1]:.3f}", file=sys.stderr)
    seconds = {name: round(median(took), 3) for name, took in runs.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "spread": {name: round(max(took) / min(took), 2) for name, took in runs.items() if len(took) > 1},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
