"""Every registered query against its SQL counterpart, at the smallest scale."""

import pytest

from compare import connection, entry, oracle_rows, spark_rows
from helpers import plan
from opsflow.oracle import ORACLE_SQL
from opsflow.registry import QUERIES
from opsflow.session import job_scope
from opsflow.sources.tables import path_exists

SF = "/root/testdata/sf0.001"
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups")


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    with job_scope(spark) as folder:
        df = entry.queries()[name](spark, SF)
        text = plan(df)
        assert not [node for node in UNWANTED if node in text]
        columns, got = spark_rows(df)
    assert not path_exists(spark, folder)
    assert got
    wanted_columns, wanted = oracle_rows(con, name)
    assert columns == wanted_columns
    assert got == wanted


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry(spark):
    assert entry.entry(spark).count() == 10
