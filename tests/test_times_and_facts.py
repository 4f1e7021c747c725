from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowlens.config import LayerConfig
from flowlens.functions.times import AGE_BUCKETS, CYCLE_BUCKETS, bucket, elapsed_days, percentile
from flowlens.operators import aggregates, dimensions, facts

CONFIG = LayerConfig(as_of="2020-06-30 12:00:00")


def when(text):
    return datetime.fromisoformat(text)


@pytest.mark.parametrize(
    ("start", "end", "days"),
    [
        ("2020-01-01 23:00:00", "2020-01-02 01:00:00", 0),
        ("2020-01-01 23:00:00", "2020-01-02 23:00:00", 1),
        ("2020-01-01 23:00:00", "2020-01-02 22:59:59", 0),
        ("2020-01-03 00:00:00", "2020-01-01 12:00:00", -1),
        ("2020-01-01 00:00:00", None, None),
    ],
)
def test_days_are_full_elapsed_days(spark, start, end, days):
    frame = spark.createDataFrame([(start, end)], "a string, b string")
    result = frame.select(
        elapsed_days(F.col("a").cast("timestamp"), F.col("b").cast("timestamp")).alias("days")
    )
    assert result.first().days == days


def test_bucket_edges(spark):
    frame = spark.createDataFrame(
        [(d,) for d in (0, 6, 7, 13, 14, 29, 30, 89, 90, None)], "d int"
    )
    labels = [r.b for r in frame.select(bucket(F.col("d"), AGE_BUCKETS).alias("b")).collect()]
    assert labels == (
        ["0-7d"] * 2 + ["7-14d"] * 2 + ["14-30d"] * 2 + ["30-90d"] * 2 + ["90d+"] * 2
    )
    cycle = [r.b for r in frame.select(bucket(F.col("d"), CYCLE_BUCKETS).alias("b")).collect()]
    assert cycle[0] == "< 1d" and cycle[-1] == "90d+"


def test_percentile_stays_close_on_large_groups(spark):
    numbers = spark.range(200000).select((F.col("id") * 7919 % 200000).alias("n"))
    found = numbers.agg(percentile(F.col("n"), 0.9).alias("p")).first().p
    exact = 179999  # the 180,000th smallest of 0, 1, 2, ...
    assert abs(found - exact) <= 200000 / 10000


def issue_times(spark, rows):
    frame = spark.createDataFrame(
        rows, "created_at timestamp, resolved_at timestamp, first_in_progress_at timestamp"
    )
    return facts.issue_times(frame, CONFIG).collect()


def test_issue_times(spark):
    open_issue, resolved, unstarted = issue_times(
        spark,
        [
            (when("2020-06-01 12:00:00"), None, None),
            (when("2020-01-01"), when("2020-01-11"), when("2020-01-04")),
            (when("2020-01-01"), when("2020-01-11"), None),
        ],
    )
    assert (open_issue.age_days, open_issue.age_bucket) == (29, "14-30d")
    assert open_issue.cycle_time_days is None and open_issue.lead_time_days is None
    assert (resolved.cycle_time_days, resolved.lead_time_days) == (7, 10)
    assert resolved.age_days is None and resolved.age_bucket is None
    assert unstarted.cycle_time_days is None and unstarted.lead_time_days == 10


def test_project_without_issues_counts_one_open(spark):
    projects = spark.createDataFrame(
        [(1, "A", "Alpha", 5, "u1"), (2, "B", "Beta", None, None)],
        "id long, project_key string, name string, project_category_id long, lead_id string",
    ).withColumns(
        {
            "description": F.lit(None).cast("string"),
            "project_type_key": F.lit("x"),
            "is_archived": F.lit(False),
        }
    )
    categories = spark.createDataFrame([(5, "Cat")], "id long, name string")
    users = spark.createDataFrame([("u1", "Una")], "account_id string, display_name string")
    issues = spark.createDataFrame(
        [("1", 1, None), ("2", 1, when("2020-01-01")), ("3", None, None)],
        "id string, project_id long, resolved_at timestamp",
    )
    rows = {
        r.project_key: r
        for r in dimensions.dim_project(projects, categories, users, issues).collect()
    }
    assert (rows["A"].total_issues, rows["A"].open_issues, rows["A"].resolved_issues) == (2, 1, 1)
    assert (rows["A"].category_name, rows["A"].lead_name) == ("Cat", "Una")
    assert (rows["B"].total_issues, rows["B"].open_issues, rows["B"].resolved_issues) == (0, 1, 0)


def test_user_groups_are_sorted_and_empty_without_any(spark):
    users = spark.createDataFrame([("a", "A"), ("b", "B")], "account_id string, display_name string")
    groups = spark.createDataFrame(
        [("a", "g2", "zeta"), ("a", "g1", "alpha"), ("a", "g3", None)],
        "account_id string, group_id string, group_name string",
    )
    rows = {r.account_id: r.groups for r in dimensions.dim_user(users, groups).collect()}
    assert rows == {"a": "alpha, zeta", "b": ""}


def test_calendar(spark):
    issues = spark.createDataFrame([(when("2020-02-29 10:00:00"),)], "created_at timestamp")
    days = dimensions.dim_date(issues, CONFIG)
    first, last = days.agg(F.min("date_key"), F.max("date_key")).first()
    assert (first, last) == (date(2018, 3, 1), date(2021, 6, 30))
    sunday = days.where(F.col("date_key") == date(2021, 1, 3)).first()
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (1, "Sun", True)
    assert (sunday.iso_week, sunday.month_name) == (53, "Jan")


STATUSES = "id long, name string, status_category_id long"


def transitions(spark, history):
    changes = facts.status_changes(
        spark.createDataFrame(
            history, "issue_id string, field_id string, value string, updated_at timestamp"
        ),
        CONFIG,
    )
    issues = spark.createDataFrame(
        [("1", 7, "A-1")], "id string, project_id long, issue_key string"
    )
    statuses = spark.createDataFrame([(1, "To Do", 10), (3, "Review", 11)], STATUSES)
    categories = spark.createDataFrame(
        [(10, "new"), (11, "indeterminate")], "id long, category_key string"
    )
    rows = facts.fct_issue_transitions(changes, issues, statuses, categories).collect()
    return sorted(rows, key=lambda row: (row.issue_id, row.entered_at))


def test_transitions(spark):
    first, second, lonely = transitions(
        spark,
        [
            ("1", "status", "1", when("2020-01-01 00:00:00")),
            ("1", "status", " 3", when("2020-01-01 01:30:00.900")),
            ("1", "other", "9", when("2020-01-01 01:00:00")),
            ("2", "status", "gone", when("2020-01-05 00:00:00")),
        ],
    )
    assert first.duration_hours == Decimal("1.500000")
    assert (first.to_status, first.to_category_key) == ("To Do", "new")
    assert first.from_status_id is None and first.project_id == 7
    assert (second.from_status, second.to_status, second.to_status_id) == ("To Do", "Review", " 3")
    assert second.duration_hours is None
    assert lonely.to_status is None and lonely.project_id is None


def test_in_progress_matches_the_text_of_the_id(spark):
    history = spark.createDataFrame(
        [
            ("1", "status", " 3", when("2020-01-01")),
            ("1", "status", "3", when("2020-01-03")),
            ("1", "status", "3", when("2020-01-02")),
            ("1", "other", "3", when("2020-01-01")),
            ("2", "status", "1", when("2020-01-01")),
        ],
        "issue_id string, field_id string, value string, updated_at timestamp",
    )
    statuses = spark.createDataFrame([(1, "To Do", 10), (3, "Review", 11)], STATUSES)
    categories = spark.createDataFrame(
        [(10, "new"), (11, "indeterminate")], "id long, category_key string"
    )
    rows = facts.first_in_progress(history, statuses, categories, CONFIG).collect()
    assert [(r.issue_id, r.started_at) for r in rows] == [("1", when("2020-01-02"))]


def test_current_sprint_is_the_highest_started_id(spark):
    members = spark.createDataFrame(
        [(1, "a"), (2, "a"), (3, "a"), (3, "b")], "sprint_id long, issue_id string"
    )
    sprints = spark.createDataFrame(
        [(1, "active"), (2, "closed"), (3, "future")], "id long, state string"
    )
    rows = facts.current_sprint(members, sprints).collect()
    assert [tuple(r) for r in rows] == [("a", 2)]


def test_sprint_velocity(spark):
    members = spark.createDataFrame(
        [(1, "a"), (1, "b"), (1, "c"), (1, "gone"), (2, "d")], "sprint_id long, issue_id string"
    )
    sprints = spark.createDataFrame(
        [
            (1, "S1", when("2020-02-01"), when("2020-01-20"), 4),
            (2, "S2", when("2020-02-01"), None, 5),
            (3, "S3", when("2020-02-01"), None, 4),
        ],
        "id long, name string, end_date timestamp, complete_date timestamp, board_id long",
    ).withColumns(
        {
            "state": F.lit("closed"),
            "start_date": F.lit("2020-01-10").cast("timestamp"),
            "goal": F.lit(None).cast("string"),
        }
    )
    issues = spark.createDataFrame(
        [
            ("a", 3.0, when("2020-01-20")),
            ("b", 1.0, when("2020-01-25")),
            ("c", None, when("2019-12-01")),
            ("d", None, None),
        ],
        "id string, story_points double, resolved_at timestamp",
    )
    boards = spark.createDataFrame([(4, 7)], "id long, project_id long")
    projects = spark.createDataFrame([(7, "A")], "id long, project_key string")
    rows = {
        r.sprint_id: r
        for r in facts.fct_sprint_velocity(members, sprints, issues, boards, projects).collect()
    }
    assert set(rows) == {1, 2}
    assert (rows[1].issues_in_sprint, rows[1].issues_completed) == (4, 2)
    assert (rows[1].points_in_sprint, rows[1].points_completed) == (4.0, 3.0)
    assert rows[1].completion_ratio == 0.75 and rows[1].project_key == "A"
    assert (rows[2].points_in_sprint, rows[2].points_completed) == (0.0, 0.0)
    assert rows[2].completion_ratio is None and rows[2].project_id is None


def test_flow_matches_null_projects_and_keeps_both_sides(spark):
    rows = spark.createDataFrame(
        [
            (None, when("2020-01-01 09:00:00"), when("2020-01-01 18:00:00"), 2.0),
            (1, when("2020-01-01 09:00:00"), None, None),
            (1, when("2020-01-02 09:00:00"), when("2020-01-05 09:00:00"), 5.0),
        ],
        "project_id long, created_at timestamp, resolved_at timestamp, story_points double",
    ).withColumns(
        {
            "project_key": F.lit("K"),
            "project_name": F.lit("N"),
            "is_resolved": F.col("resolved_at").isNotNull(),
        }
    )
    found = {
        (r.flow_date.day, r.project_id): (
            r.created_issues,
            r.resolved_issues,
            r.created_points,
            r.resolved_points,
            r.net_backlog_change,
        )
        for r in aggregates.created_resolved_daily(rows).collect()
    }
    assert found == {
        (1, None): (1, 1, 2.0, 2.0, 0),
        (1, 1): (1, 0, 0.0, 0.0, 1),
        (2, 1): (1, 0, 5.0, 0.0, 1),
        (5, 1): (0, 1, 0.0, 5.0, -1),
    }


def test_flow_since_a_day_is_the_flow_filtered(spark):
    rows = spark.createDataFrame(
        [
            (1, when("2020-01-01"), when("2020-01-05"), 2.0),
            (1, when("2020-01-04"), None, 1.0),
            (2, when("2020-01-02"), when("2020-01-03"), 3.0),
        ],
        "project_id long, created_at timestamp, resolved_at timestamp, story_points double",
    ).withColumns(
        {
            "project_key": F.lit("K"),
            "project_name": F.lit("N"),
            "is_resolved": F.col("resolved_at").isNotNull(),
        }
    )
    first = F.lit("2020-01-03").cast("date")
    whole = aggregates.created_resolved_daily(rows).where(F.col("flow_date") >= first)
    recent = aggregates.created_resolved_daily(rows, first)
    assert sorted(map(tuple, recent.collect())) == sorted(map(tuple, whole.collect()))
    assert recent.count() == 3


def test_recent_counts_have_no_upper_bound(spark):
    rows = spark.createDataFrame(
        [
            (when("2020-05-31 00:00:00"), when("2021-01-01"), True, None),
            (when("2020-05-30 23:59:59"), None, False, 31),
        ],
        "created_at timestamp, resolved_at timestamp, is_resolved boolean, age_days long",
    ).withColumns(
        {
            "project_id": F.lit(1),
            "project_key": F.lit("K"),
            "project_name": F.lit("N"),
            "priority": F.lit("Blocker"),
            "cycle_time_days": F.lit(None).cast("bigint"),
            "lead_time_days": F.lit(4).cast("bigint"),
        }
    )
    row = aggregates.agg_project_health(rows, CONFIG).first()
    assert (row.created_last_30d, row.resolved_last_30d) == (1, 1)
    assert (row.open_critical, row.stale_open) == (1, 1)
    assert row.avg_lead_time_days == 4.0 and row.avg_cycle_time_days is None
