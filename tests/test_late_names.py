"""The issue fact shuffles its wide rows once; the status history is read once where no issue is hot."""

import re

import pytest
from pyspark.sql import functions as F

from flowlens.functions.neighbours import with_neighbours
from flowlens.operators.expectations import HeavyKey, Watch
from sampleset.queries import workspace

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def without_broadcasts(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    yield
    spark.conf.set(setting, before)


def exchanges_with(frame, column):
    """The partitioning of each exchange that moves a column."""
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = frame._jdf.queryExecution().explainString(mode)
    found = []
    for block in text.split("\n\n"):
        if re.match(r"\(\d+\) Exchange", block.strip()) and re.search(rf"Input \[\d+\]: .*\b{column}#", block):
            found.append(re.search(r"Arguments: (.*?)(, ENSURE|, \[plan)", block).group(1))
    return found


@pytest.mark.parametrize("column", ["summary", "labels"])
def test_wide_rows_are_shuffled_once_and_by_issue(spark, without_broadcasts, column):
    fact = workspace(spark, SMALL).pipeline.frame("gold.fct_issue")
    found = exchanges_with(fact, column)
    assert len(found) == 1 and re.match(r"hashpartitioning\(issue_id#", found[0]), found


@pytest.mark.parametrize("column", ["project_name", "status_name", "assignee_name"])
def test_names_of_small_lookups_are_not_shuffled(spark, column):
    fact = workspace(spark, SMALL).pipeline.frame("gold.fct_issue")
    assert not exchanges_with(fact, column)


def test_repeated_ids_keep_their_own_names(spark):
    """Two rows of one id with different keys: each gets its names, and none is multiplied."""
    layer = workspace(spark, SMALL)
    issues = layer.pipeline.silver("issue")
    one = issues.limit(1)
    other = one.withColumn("assignee_id", F.lit("S2")).withColumn("priority_id", F.lit(None).cast("bigint"))
    doubled = one.unionByName(other).unionByName(one)
    made = layer.pipeline
    from flowlens.operators import facts

    names = "silver.project silver.issue_type gold.dim_status silver.priority silver.resolution silver.user "
    names += "silver.epic_issue step.current_sprint gold.dim_sprint step.first_in_progress"
    rows = facts.fct_issue(doubled, *made.tables(names.split()), made.config).collect()
    assert len(rows) == 3
    assert [(r.assignee_id, r.priority is None) for r in rows].count(("S2", True)) == 1


def test_usual_histories_are_read_once(spark):
    layer = workspace(spark, SMALL)
    layer.pipeline.silver("issue_field_history")
    plan = layer.pipeline.frame("step.status_changes")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Window") == 1 and "Join" not in plan


def test_a_bound_above_the_limit_keeps_the_split(spark):
    rows = spark.createDataFrame([("a", i, "x") for i in range(20)], "k string, t int, v string")
    options = {"key": "k", "time": "t", "ties": ["v"], "following": {"n": "t"}, "most": 10}
    plans = {
        largest: with_neighbours(rows, largest=largest, **options)._jdf.queryExecution().executedPlan().toString()
        for largest in (None, 10, 11)
    }
    assert "Join" not in plans[10] and "Join" in plans[11] and "Join" in plans[None]
    want = sorted(map(str, with_neighbours(rows, **options).collect()))
    assert sorted(map(str, with_neighbours(rows, largest=10, **options).collect())) == want


@pytest.mark.parametrize("hot", [0, 700, 5000])
def test_the_bound_is_never_too_low(spark, hot):
    """Values with equal shares, one hot value, and rows that do not count."""
    spread = spark.range(20_000).select(
        F.when(F.col("id") < hot, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("k"),
        (F.col("id") % 4 > 0).alias("counts"),
    )
    true = spread.where("counts").groupBy("k").count().agg(F.max("count")).first()[0]
    for tracked in (100, 10_000):
        watch = Watch("t", [], {"top": HeavyKey("k", "counts", tracked)})
        watch.over(spread).count()
        assert true <= watch.counts()["top"]
    assert watch.counts()["top"] <= true + 2 * 3.5 * 20_000 / 16_384 + 1


def test_no_rows_have_a_bound(spark):
    watch = Watch("t", [], {"top": HeavyKey("k", "k <> 'x'")})
    watch.over(spark.createDataFrame([], "k string")).count()
    assert watch.counts() == {"rows": 0, "top": 0}
