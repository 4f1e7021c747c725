"""What reaches the scans of the headline queries."""

import pytest

from sampleset.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def scans(spark, name):
    """Lines of the scans of a query's formatted plan."""
    frame = QUERIES[name](spark, SMALL)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = frame._jdf.queryExecution().explainString(mode)
    wanted = ("PushedFilters", "PartitionFilters", "ReadSchema")
    return "\n".join(line for line in text.splitlines() if line.startswith(wanted))


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("ds_issue_open", "NOT is_resolved"),
        ("ds_issue_resolved_180", "GreaterThanOrEqual(resolved_at,2001-02-03"),
        ("ds_flow_weekly", "GreaterThanOrEqual(created_at,2001-05-10"),
        ("ds_flow_weekly", "GreaterThanOrEqual(resolved_at,2001-05-10"),
        ("status_changes", "EqualTo(field_id,status)"),
        ("first_in_progress", "EqualTo(field_id,status)"),
        ("q_hours_90d", "GreaterThanOrEqual(work_date,2001-05-04)"),
        ("q_velocity_last5", "EqualTo(state,closed)"),
        ("q_oldest_bugs", "EqualTo(issue_type,Bug)"),
    ],
)
def test_filters_reach_the_scan(spark, name, expected):
    assert expected in scans(spark, name)


@pytest.mark.parametrize(
    ("name", "unread"),
    [
        ("metric_global_wip", ("summary", "labels", "project_key", "created_at")),
        ("status_changes", ("is_current",)),
        ("agg_project_health", ("summary", "assignee_id", "labels")),
        ("silver_sprint_issue", ("summary", "component_ids", "created")),
    ],
)
def test_scans_read_only_what_is_needed(spark, name, unread):
    read = scans(spark, name)
    assert not [column for column in unread if f"{column}:" in read]
