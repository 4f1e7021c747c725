"""One key with a third of all rows: joins are split, results stay whole."""

import pytest
from pyspark.sql import functions as F

from flowlens.config import LayerConfig
from flowlens.operators import bridges, facts

ROWS = 30000

# Thresholds scaled down to the size of the test data.
SMALL_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30000",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small_scale(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL_SCALE}
    for key, value in SMALL_SCALE.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def hot(spark, key, rest):
    """Ids 0..ROWS-1; every third one has the same key, the others spread out."""
    number = F.col("id")
    return spark.range(0, ROWS, 1, 6).withColumn(
        key, F.when(number % 3 == 0, F.lit(0)).otherwise(number % rest + 1)
    )


def executed(frame):
    rows = frame.collect()
    return rows, frame._jdf.queryExecution().executedPlan().toString()


def test_epic_with_a_third_of_all_children(spark, small_scale):
    issues = hot(spark, "parent_id", 997).select(
        "id",
        "parent_id",
        F.when(F.col("id") <= 997, "Epic").otherwise("Task").alias("issueType"),
    )
    types = spark.createDataFrame([(1, "Epic"), (2, "Task")], "id int, name string")
    rows, plan = executed(bridges.epic_issue(issues, types, "epic"))
    assert len(rows) == ROWS
    assert "skew=true" in plan


def test_issue_with_a_third_of_all_history(spark, small_scale):
    history = hot(spark, "issue_id", 997).select(
        F.col("issue_id").cast("string").alias("issue_id"),
        F.lit("status").alias("field_id"),
        (F.col("id") % 4 + 1).cast("string").alias("value"),
        F.timestamp_seconds(F.col("id") * 1200).alias("updated_at"),
    )
    changes = facts.status_changes(history, LayerConfig())
    issues = spark.range(998).select(
        F.col("id").cast("string").alias("id"),
        F.lit(1).alias("project_id"),
        F.lit("K").alias("issue_key"),
    )
    statuses = spark.createDataFrame(
        [(n, f"S{n}", 1) for n in range(1, 5)], "id long, name string, status_category_id long"
    )
    categories = spark.createDataFrame([(1, "new")], "id long, category_key string")
    frame = facts.fct_issue_transitions(changes, issues, statuses, categories)
    rows, plan = executed(frame)
    assert len(rows) == ROWS
    assert sum(row.exited_at is None for row in rows) == 998
    assert sum(row.from_status_id is None for row in rows) == 998
    assert "skew=true" in plan


def test_assignee_of_a_third_and_no_assignee_for_a_third(spark, small_scale):
    issues = hot(spark, "person", 997).select(
        F.col("id").cast("string").alias("id"),
        F.lit(7).cast("bigint").alias("time_spent_seconds"),
        F.when(F.col("id") % 3 != 1, F.concat(F.lit("u"), "person")).alias("author_id"),
        F.col("id").cast("string").alias("issue_id"),
        F.lit("2020-01-01").cast("timestamp").alias("started_at"),
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )
    users = spark.range(998).select(
        F.concat(F.lit("u"), "id").alias("account_id"),
        F.concat(F.lit("User "), "id").alias("display_name"),
    )
    no_issues = spark.createDataFrame([], "id string, issue_key string, project_id long")
    no_projects = spark.createDataFrame([], "id long, project_key string, name string")
    rows, plan = executed(facts.fct_worklog(issues, no_issues, no_projects, users))
    assert len(rows) == ROWS
    assert sum(row.author_name is None for row in rows) == ROWS // 3
    assert "skew=true" in plan


def test_sprint_with_a_third_of_all_issues(spark, small_scale):
    members = hot(spark, "sprint_id", 997).select(
        "sprint_id", F.col("id").cast("string").alias("issue_id")
    )
    sprints = spark.range(998).select(
        "id",
        F.col("id").cast("string").alias("name"),
        F.lit("closed").alias("state"),
        F.lit("2020-01-01").cast("timestamp").alias("start_date"),
        F.lit("2020-02-01").cast("timestamp").alias("end_date"),
        F.lit(None).cast("timestamp").alias("complete_date"),
        F.lit(None).cast("string").alias("goal"),
        F.lit(1).cast("bigint").alias("board_id"),
    )
    issues = spark.range(ROWS).select(
        F.col("id").cast("string").alias("id"),
        F.lit(2.0).alias("story_points"),
        F.lit("2020-01-15").cast("timestamp").alias("resolved_at"),
    )
    boards = spark.createDataFrame([(1, 1)], "id long, project_id long")
    projects = spark.createDataFrame([(1, "K")], "id long, project_key string")
    rows, plan = executed(facts.fct_sprint_velocity(members, sprints, issues, boards, projects))
    assert len(rows) == 998
    assert sum(row.issues_in_sprint for row in rows) == ROWS
    assert max(row.points_completed for row in rows) == 2.0 * (ROWS // 3)
    assert "skew=true" in plan
