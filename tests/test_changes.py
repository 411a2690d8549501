from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import rows, ts
from opsflow.operators import changes as chg, versions
from opsflow.sources.tables import create_if_missing

RUN, OLD = ts("2024-01-02"), ts("2024-01-01")
TABLE = "id int, a string, b int"
FACT = TABLE + ", last_updated_ts timestamp_ntz"
FEED = TABLE + ", dml_action string, is_update boolean"
few = settings(max_examples=10, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
versions_of_table = st.dictionaries(
    st.integers(0, 12), st.tuples(st.one_of(st.none(), st.sampled_from("xyz")), st.one_of(st.none(), st.integers(0, 2))), max_size=10
)


def table(spark, content):
    return spark.createDataFrame([(k, *v) for k, v in content.items()], TABLE)


def test_change_feed(spark):
    before = table(spark, {1: ("a", 1), 2: ("b", None), 3: ("c", 3), 4: (None, 4)})
    after = table(spark, {1: ("a", 1), 2: ("b", 2), 4: (None, 4), 5: ("e", 5)})
    assert rows(chg.changes(before, after, "id")) == [
        (2, "b", 2, "INSERT", True),
        (2, "b", None, "DELETE", True),
        (3, "c", 3, "DELETE", False),
        (5, "e", 5, "INSERT", False),
    ]
    assert rows(chg.changes(before, after, "id", append_only=True)) == [(5, "e", 5, "INSERT", False)]


@few
@given(versions_of_table, versions_of_table)
def test_feed_merged_into_the_old_version_gives_the_new(spark, old, new):
    before, after = table(spark, old), table(spark, new)
    stamped = before.withColumn("last_updated_ts", F.lit(OLD).cast("timestamp_ntz"))
    merged = chg.merge_changes(stamped, chg.changes(before, after, "id"), "id", ["a", "b"], RUN)
    wanted = [(k, *v, OLD if old.get(k) == v else RUN) for k, v in new.items()]
    assert rows(merged) == sorted(wanted, key=repr)


def merged(spark, feed, sequence=None):
    target = spark.createDataFrame([(k, "old", 0, OLD) for k in (1, 2, 3, 4, 7)], FACT)
    schema = FEED + (", seq int" if sequence else "")
    return rows(chg.merge_changes(target, spark.createDataFrame(feed, schema), "id", ["b"], RUN, sequence=sequence))


def test_merge_clauses(spark):
    got = merged(
        spark,
        [
            (1, "new", 1, "DELETE", False),
            (2, "new", 2, "INSERT", True),
            (3, "new", 3, "INSERT", False),
            (5, "new", 5, "INSERT", False),
            (6, "new", 6, "INSERT", True),
            (8, "new", 8, "DELETE", False),
        ],
    )
    assert got == [
        (2, "old", 2, RUN),  # update: only b and the stamp
        (3, "old", 0, OLD),  # matched plain insert: untouched
        (4, "old", 0, OLD),
        (5, "new", 5, RUN),
        (6, "new", 6, RUN),
        (7, "old", 0, OLD),
    ]


def test_update_pair_and_delete_then_insert(spark):
    got = merged(
        spark,
        [
            (1, "old", 0, "DELETE", True),
            (1, "new", 1, "INSERT", True),
            (2, "old", 0, "DELETE", False),
            (2, "again", 9, "INSERT", False),
        ],
    )
    assert (1, "old", 1, RUN) in got
    assert (2, "again", 9, RUN) in got


def test_order_within_a_feed(spark):
    got = merged(
        spark,
        [
            (1, "x", 1, "INSERT", True, 1),
            (1, "x", 2, "INSERT", True, 2),
            (2, "x", 1, "INSERT", True, 1),
            (2, "x", 1, "DELETE", False, 2),
            (9, "x", 1, "INSERT", False, 1),
            (9, "x", 1, "DELETE", False, 2),
        ],
        "seq",
    )
    assert (1, "old", 2, RUN) in got
    assert not [r for r in got if r[0] in (2, 9)]


def test_unordered_changes_of_one_key_are_refused(spark):
    twice = [(1, "x", 90, "INSERT", True), (1, "x", 50, "INSERT", True)]
    with pytest.raises(Exception, match="order column"):
        merged(spark, twice)
    # In the order of their numbers the later one holds, whatever its value.
    assert (1, "old", 50, RUN) in merged(spark, [(*twice[0], 1), (*twice[1], 2)], "seq")


operation = st.sampled_from(["update", "delete", "insert"])


@few
@given(st.lists(st.tuples(st.integers(1, 9), operation, st.integers(0, 99)), max_size=20))
def test_ordered_batch_equals_its_last_changes(spark, steps):
    kinds = {"update": ("INSERT", True), "delete": ("DELETE", False), "insert": ("INSERT", False)}
    feed = [(k, "new", v, *kinds[kind], n) for n, (k, kind, v) in enumerate(steps)]
    wanted = {k: ("old", 0, OLD) for k in (1, 2, 3, 4, 7)}
    for key in {k for k, _, _ in steps}:
        own = [(kind, v) for k, kind, v in steps if k == key]
        kind, v = own[-1]
        if kind == "delete":
            wanted.pop(key, None)
        elif key not in wanted or any(o == "delete" for o, _ in own):
            wanted[key] = ("new", v, RUN)
        elif kind == "update":
            wanted[key] = ("old", v, RUN)
    assert merged(spark, feed, "seq") == sorted(((k, *v) for k, v in wanted.items()), key=repr)


def test_repeated_keys_of_a_version_are_refused(spark):
    once = table(spark, {1: ("a", 1), 2: ("b", 2)})
    assert rows(chg.require_unique(once, "id")) == rows(once)
    with pytest.raises(Exception, match="not unique"):
        chg.require_unique(once.union(once), "id").collect()


def test_replay_changes_nothing(spark):
    before, after = table(spark, {1: ("a", 1), 2: ("b", 2)}), table(spark, {2: ("b", 3), 3: ("c", 3)})
    feed = chg.changes(before, after, "id")
    target = before.withColumn("last_updated_ts", F.lit(OLD).cast("timestamp_ntz"))
    once = chg.merge_changes(target, feed, "id", ["a", "b"], RUN)
    assert rows(chg.merge_changes(once, feed, "id", ["a", "b"], RUN)) == rows(once)


def test_null_keys_are_left_alone(spark):
    before = spark.createDataFrame([(None, "a", 1), (1, "b", 2)], TABLE)
    after = spark.createDataFrame([(None, "a", 1), (1, "b", 3)], TABLE)
    assert {r["id"] for r in chg.changes(before, after, "id").collect()} == {1}
    target = before.withColumn("last_updated_ts", F.lit(OLD).cast("timestamp_ntz"))
    got = rows(chg.merge_changes(target, chg.changes(before, after, "id"), "id", ["b"], RUN))
    assert got == [(1, "b", 3, RUN), (None, "a", 1, OLD)]
    kept = spark.createDataFrame([(None, "p", 5, OLD)], "k int, p string, v int, updated_at timestamp_ntz")
    source = spark.createDataFrame([(1, "p", 7)], "k int, p string, v int")
    assert rows(chg.upsert(kept, source, ["k", "p"], ["v"], RUN)) == [(1, "p", 7, RUN), (None, "p", 5, OLD)]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "p", 5, OLD), (2, "p", 6, OLD)], "k int, p string, v int, updated_at timestamp_ntz")
    source = spark.createDataFrame([(2, "p", 7), (2, "q", 8)], "k int, p string, v int")
    assert rows(chg.upsert(target, source, ["k", "p"], ["v"], RUN)) == [(1, "p", 5, OLD), (2, "p", 7, RUN), (2, "q", 8, RUN)]


LOG = "id int, v int, commit_ts timestamp_ntz, commit_id int, action string"
T0 = datetime(2024, 1, 1)


def log(spark, entries):
    return spark.createDataFrame([(k, v, T0 + timedelta(hours=h), n, a) for n, (k, v, h, a) in enumerate(entries)], LOG)


def test_as_of_bounds_and_deleted_keys(spark):
    history = log(spark, [(1, 10, 0, "INSERT"), (2, 20, 0, "INSERT"), (1, 11, 2, "UPDATE"), (2, 20, 2, "DELETE"), (3, 30, 3, "INSERT")])
    at = T0 + timedelta(hours=2)
    assert rows(versions.as_of(history, ["id"], at), "id", "v") == [(1, 11)]
    assert rows(versions.as_of(history, ["id"], at, inclusive=False), "id", "v") == [(1, 10), (2, 20)]
    assert rows(versions.before_commit(history, ["id"], 3), "id", "v") == [(1, 11), (2, 20)]
    assert versions.as_of(history, ["id"], T0 - timedelta(hours=1)).isEmpty()
    assert rows(versions.added_since(history, ["id"], at), "id") == [(3,)]


@few
@given(versions_of_table, versions_of_table)
def test_logged_feeds_give_every_version_back(spark, old, new):
    none, before, after = table(spark, {}), table(spark, old), table(spark, new)
    history = versions.log_rows(chg.changes(none, before, "id"), "id", OLD, 1).unionByName(
        versions.log_rows(chg.changes(before, after, "id"), "id", RUN, 2)
    )
    assert rows(versions.as_of(history, ["id"], OLD), "id", "a", "b") == rows(before)
    assert rows(versions.as_of(history, ["id"], RUN), "id", "a", "b") == rows(after)
    assert rows(versions.before_commit(history, ["id"], 2), "id", "a", "b") == rows(before)


def test_restore_writes_a_new_place(spark, tmp_path):
    history = log(spark, [(1, 10, 0, "INSERT"), (1, 10, 1, "DELETE")])
    restored = versions.restore(history, ["id"], 1, str(tmp_path / "r"))
    assert rows(restored, "id", "v") == [(1, 10)]


def test_restore_swaps_a_table_over(spark, tmp_path):
    history = log(spark, [(1, 10, 0, "INSERT"), (2, 20, 1, "INSERT"), (1, 10, 2, "DELETE")])
    newest = versions.latest_state(history, ["id"])
    newest.write.parquet(str(tmp_path / "now"))
    create_if_missing(spark, "opsflow_swapped", newest.schema, str(tmp_path / "now"))
    try:
        assert rows(spark.table("opsflow_swapped"), "id") == [(2,)]
        versions.restore_table(history, ["id"], 2, "opsflow_swapped", str(tmp_path / "then"))
        assert rows(spark.table("opsflow_swapped"), "id") == [(1,), (2,)]
    finally:
        spark.sql("DROP TABLE opsflow_swapped")


@few
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9), st.integers(0, 5), st.sampled_from(["INSERT", "UPDATE", "DELETE"])), min_size=1, max_size=15))
def test_state_now_is_the_replayed_log(spark, entries):
    state = {}
    for n, (k, v, h, a) in sorted(enumerate(entries), key=lambda e: (e[1][2], e[0])):
        state[k] = None if a == "DELETE" else v
    wanted = sorted((k, v) for k, v in state.items() if v is not None)
    assert rows(versions.as_of(log(spark, entries), ["id"], T0 + timedelta(days=1)), "id", "v") == wanted
