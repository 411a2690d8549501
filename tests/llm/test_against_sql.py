"""Queries that SQL can express, on the test tables."""

import pytest
from compare import connection, entry, oracle_rows, spark_rows

from opsflow.llm.oracle import ORACLE_SQL
from opsflow.session import job_scope

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    with job_scope(spark):
        got = spark_rows(entry.queries()[name](spark, SF))
    assert got == oracle_rows(connection(SF), name)
    assert got[1]


def test_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()
