"""Every registered query against its SQL, and what its plan may not contain."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from sampleset.compare import differences
from sampleset.oracle import ORACLE
from sampleset.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    ours = QUERIES[name](spark, SMALL)
    assert "void" not in dict(ours.dtypes).values()
    assert differences(ours.toArrow(), duck.sql(ORACLE[name]).to_arrow_table()) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_without_broadcasts_has_no_cross_join(spark, name):
    """Joins stay equality joins when nothing is small enough to broadcast."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns[:2] == ["project_key", "project_name"]
    assert rows.count() == 25
