"""Compares every registered query with its SQL counterpart; run with a scale folder and optional names."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def connection(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else number + 0.0
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows_by_name(columns, rows):
    """Rows as tuples in the order of the column names, sorted."""
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in places) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), rows_by_name(df.columns, df.collect())


def oracle_rows(con, name):
    result = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    return sorted(columns), rows_by_name(columns, result.fetchall())


def main() -> None:
    from conftest import test_session
    from opsflow.session import job_scope

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark, con = test_session(), connection(sf_dir)
    for name in only or entry.queries():
        start = time.time()
        try:
            with job_scope(spark):
                columns, got = spark_rows(entry.queries()[name](spark, sf_dir))
        except Exception as error:
            print(f"ERROR {name}: {str(error)[:1500]}")
            continue
        took = time.time() - start
        if name not in entry.oracle_sql():
            print(f"{'rows' if got else 'EMPTY':8} {name} {len(got)} rows {took:.1f}s")
            continue
        try:
            wanted_columns, wanted = oracle_rows(con, name)
        except Exception as error:
            print(f"ORACLE ERROR {name}: {str(error)[:800]}")
            continue
        same = columns == wanted_columns and got == wanted
        print(f"{'ok' if same else 'DIFFER':8} {name} {len(got)} / {len(wanted)} rows {took:.1f}s")
        if columns != wanted_columns:
            print("   columns", columns, wanted_columns)
        elif not same:
            differing = [(g, w) for g, w in zip(got, wanted) if g != w]
            print("   differing", len(differing))
            for pair in differing[:2]:
                print("   spark ", pair[0], "\n   oracle", pair[1])


if __name__ == "__main__":
    main()
