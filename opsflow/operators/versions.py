"""Past states of a table kept as a commit-stamped change log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from opsflow.functions.dates import naive
from opsflow.operators.changes import ACTION as FEED_ACTION, IS_UPDATE, net_changes
from opsflow.operators.joins import added_rows

# Log columns besides the table's own: the commit's time, its number (unique per
# row of one key) and INSERT, UPDATE or DELETE.
COMMIT_TS, COMMIT_ID, ACTION = "commit_ts", "commit_id", "action"


def latest_state(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last logged row per key, deleted keys left out.

    ``max`` over (time, number, row) combines inside the input tasks, so a key
    with a very long history arrives at its reducer as one row per task.
    """
    payload = [c for c in log.columns if c not in keys]
    body = [c for c in payload if c not in (COMMIT_TS, COMMIT_ID)]
    newest = F.max(F.struct(COMMIT_TS, COMMIT_ID, *body)).alias("_row")
    state = log.groupBy(*keys).agg(newest).select(*keys, "_row.*")
    return state.where(F.col(ACTION) != "DELETE").select(*log.columns).drop(ACTION)


def as_of(log: DataFrame, keys: Sequence[str], ts: datetime, inclusive: bool = True) -> DataFrame:
    """State at ``ts``; with ``inclusive=False`` the state just before it."""
    stamp, limit = F.col(COMMIT_TS), naive(ts)
    return latest_state(log.where(stamp <= limit if inclusive else stamp < limit), keys)


def before_commit(log: DataFrame, keys: Sequence[str], commit_id: int) -> DataFrame:
    """State just before the commit with this number."""
    return latest_state(log.where(F.col(COMMIT_ID) < F.lit(commit_id)), keys)


def added_since(log: DataFrame, keys: Sequence[str], ts: datetime) -> DataFrame:
    """Rows of the current state whose key did not exist just before ``ts``."""
    return added_rows(latest_state(log, keys), as_of(log, keys, ts, inclusive=False), keys)


def restore(log: DataFrame, keys: Sequence[str], commit_id: int, path: str) -> DataFrame:
    """Writes the state before a commit to a new path and returns it; the log is left as it is."""
    state = before_commit(log, keys, commit_id)
    state.write.mode("error").parquet(path)
    return log.sparkSession.read.schema(state.schema).parquet(path)


def restore_table(log: DataFrame, keys: Sequence[str], commit_id: int, table: str, path: str) -> DataFrame:
    """Restores a catalog table in place: the state goes to the new ``path`` and the table's name is swapped over to it.

    Readers of the name see the old rows until the swap and the restored ones after it;
    the old files stay where they are.
    """
    spark = log.sparkSession
    restore(log, keys, commit_id, path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)

def log_rows(feed: DataFrame, key: str, commit_ts: datetime, commit_id: int) -> DataFrame:
    """One commit's change feed as rows to append to the log, one row per key."""
    net = net_changes(feed, key).withColumnRenamed(FEED_ACTION, ACTION).drop(IS_UPDATE, "replaced")
    stamps = {COMMIT_TS: naive(commit_ts), COMMIT_ID: F.lit(commit_id).cast("bigint")}
    return net.withColumns(stamps)
