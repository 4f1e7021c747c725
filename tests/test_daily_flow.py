"""Created and resolved days from one pass over the issues."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowlens.operators.aggregates import created_resolved_daily
from sampleset.queries import workspace

SMALL = "/root/testdata/sf0.001"
FACTS = (
    "project_id long, project_key string, project_name string, created_at timestamp, "
    "resolved_at timestamp, is_resolved boolean, story_points double"
)
ONE, TWO = datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 11)


def flow(spark, rows, first_day=None):
    frame = created_resolved_daily(spark.createDataFrame(rows, FACTS), first_day)
    return sorted(
        (
            (str(r.flow_date), r.project_id, r.project_key, r.project_name, r.created_issues, r.resolved_issues,
             r.created_points, r.resolved_points, r.net_backlog_change)
            for r in frame.collect()
        ),
        key=str,
    )


def test_days_with_one_and_with_both_sides(spark):
    rows = [
        (1, "A", "Alpha", ONE, TWO, True, 3.0),
        (1, "A", "Alpha", TWO, None, False, None),
        (None, None, None, None, TWO, True, 1.0),
        (2, "B", "Beta", ONE, TWO, False, 5.0),  # a moment without the flag counts for nothing
    ]
    assert flow(spark, rows) == [
        ("2024-01-01", 1, "A", "Alpha", 1, 0, 3.0, 0.0, 1),
        ("2024-01-01", 2, "B", "Beta", 1, 0, 5.0, 0.0, 1),
        ("2024-01-02", 1, "A", "Alpha", 1, 1, 0.0, 3.0, 0),
        ("2024-01-02", None, None, None, 0, 1, 0.0, 1.0, -1),
        ("None", None, None, None, 1, 0, 1.0, 0.0, 1),
    ]


def test_spellings_of_a_project_are_paired(spark):
    """Two created and two resolved spellings of one day make four rows; one-sided days none more."""
    rows = [
        (1, "A", "Alpha", ONE, None, False, 1.0),
        (1, "A", "Old", ONE, None, False, 2.0),
        (1, "A", "Alpha", TWO, ONE, True, 4.0),
        (1, "A", "New", TWO, ONE, True, 8.0),
    ]
    found = flow(spark, rows)
    assert [row[3:6] for row in found if row[0] == "2024-01-01"] == [
        ("Alpha", 1, 1), ("Alpha", 1, 1), ("Old", 1, 1), ("Old", 1, 1),
    ]
    assert sorted(row[7] for row in found if row[0] == "2024-01-01") == [4.0, 4.0, 8.0, 8.0]
    assert [row[3:6] for row in found if row[0] == "2024-01-02"] == [("Alpha", 1, 0), ("New", 1, 0)]


def test_first_day_leaves_out_older_events(spark):
    rows = [(1, "A", "Alpha", ONE, TWO, True, 3.0), (1, "A", "Alpha", ONE, None, False, 1.0)]
    found = flow(spark, rows, F.lit("2024-01-02").cast("date"))
    assert found == [("2024-01-02", 1, "A", "Alpha", 0, 1, 0.0, 3.0, -1)]


def test_no_issues(spark):
    assert flow(spark, []) == []


@pytest.mark.parametrize("windowed", [False, True])
def test_one_scan_and_no_join(spark, windowed):
    facts = workspace(spark, SMALL).pipeline.gold("fct_issue")
    first = F.lit("2001-05-10").cast("date") if windowed else None
    plan = created_resolved_daily(facts, first)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan
    # The second exchange moves one row per day, project and spelling.
    assert plan.count("Exchange hashpartitioning") == 2
    if windowed:
        pushed = plan.split("PushedFilters: [")[1].split("]")[0]
        assert pushed.startswith("Or(GreaterThanOrEqual(created_at") and "GreaterThanOrEqual(resolved_at" in pushed
