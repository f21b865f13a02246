"""Every registered query against its SQL on DuckDB, and what its plan must not do."""

import pytest
from oracle import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duckdb_tables():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duckdb_tables, name):
    query = queries()[name]
    if name in oracle_sql():
        assert compare(spark, duckdb_tables, name, query, oracle_sql()[name], SMALL) == ""
    else:
        assert query(spark, SMALL).count() > 0


def test_entry(spark):
    assert "AKI_3" in entry(spark).columns


@pytest.mark.parametrize("name", ["lab_labels_wide", "align_abs", "latest_k_events", "code_lookup", "event_linearise"])
def test_plans(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "strategy=broadcast" not in plan
