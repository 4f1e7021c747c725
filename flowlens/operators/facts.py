"""Gold facts: issues, status transitions, sprint velocity and worklogs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.config import LayerConfig
from flowlens.functions.neighbours import with_neighbours
from flowlens.functions.times import AGE_BUCKETS, bucket, elapsed_days, hours
from flowlens.operators.dimensions import sprint_end

# Sprint states that count for an issue's current sprint.
STARTED_SPRINT_STATES = ("active", "closed")

# Column order of the issue fact.
ISSUE_FACT_LAYOUT = (
    "issue_id",
    "issue_key",
    "summary",
    "project_id",
    "project_key",
    "project_name",
    "issue_type_id",
    "issue_type",
    "status_id",
    "status_name",
    "status_category_key",
    "status_category",
    "priority_id",
    "priority",
    "resolution_id",
    "resolution",
    "assignee_id",
    "assignee_name",
    "reporter_id",
    "reporter_name",
    "creator_id",
    "parent_id",
    "epic_id",
    "current_sprint_id",
    "current_sprint_name",
    "created_at",
    "updated_at",
    "resolved_at",
    "due_date",
    "story_points",
    "original_estimate_seconds",
    "remaining_estimate_seconds",
    "time_spent_seconds",
    "watch_count",
    "vote_count",
    "labels",
    "first_in_progress_at",
    "is_resolved",
    "cycle_time_days",
    "lead_time_days",
    "age_days",
    "age_bucket",
)


def status_history(history: DataFrame, config: LayerConfig) -> DataFrame:
    return history.where(F.col("field_id") == config.status_field_id).select(
        "issue_id", "value", "updated_at"
    )


def first_in_progress(
    history: DataFrame, statuses: DataFrame, categories: DataFrame, config: LayerConfig
) -> DataFrame:
    """When each issue first entered a status of the in-progress category."""
    working = categories.where(F.col("category_key") == config.in_progress_category_key).select(
        F.col("id").alias("status_category_id")
    )
    values = statuses.join(working, "status_category_id", "left_semi").select(
        F.col("id").cast("string").alias("value")
    )
    return (
        status_history(history, config)
        .join(values, "value", "left_semi")
        .groupBy("issue_id")
        .agg(F.min("updated_at").alias("started_at"))
    )


def current_sprint(sprint_issues: DataFrame, sprints: DataFrame) -> DataFrame:
    """The highest id among the started sprints of each issue."""
    started = sprints.where(F.col("state").isin(*STARTED_SPRINT_STATES)).select(
        F.col("id").alias("sprint_id")
    )
    return (
        sprint_issues.join(started, "sprint_id", "left_semi")
        .groupBy("issue_id")
        .agg(F.max("sprint_id").alias("current_sprint_id"))
    )


def issue_times(issues: DataFrame, config: LayerConfig) -> DataFrame:
    """Resolution flag, cycle and lead time of resolved, age of open issues.

    Needs ``created_at``, ``resolved_at`` and ``first_in_progress_at``.
    """
    resolved = F.col("resolved_at").isNotNull()
    timed = issues.withColumns(
        {
            "is_resolved": resolved,
            "cycle_time_days": F.when(
                resolved, elapsed_days(F.col("first_in_progress_at"), F.col("resolved_at"))
            ),
            "lead_time_days": F.when(
                resolved, elapsed_days(F.col("created_at"), F.col("resolved_at"))
            ),
            "age_days": F.when(~resolved, elapsed_days(F.col("created_at"), config.now())),
        }
    )
    return timed.withColumn("age_bucket", F.when(~resolved, bucket(F.col("age_days"), AGE_BUCKETS)))


def _lookup(frame: DataFrame, key: str, **columns: str) -> DataFrame:
    """The key of a lookup and the columns to attach, under their new names."""
    renamed = [F.col(old).alias(new) for new, old in columns.items()]
    return frame.select(F.col(key).alias(next(iter(columns))), *renamed[1:])


def _with_names(rows: DataFrame, issues: DataFrame, lookups: Sequence[DataFrame]) -> DataFrame:
    """Attach the names of lookups to rows by issue; ``issues`` has the issues and their keys."""
    keys = [lookup.columns[0] for lookup in lookups]
    # An id may stand in several rows that differ in their keys: each kind is looked up once.
    names = issues.select("issue_id", *keys).repartition("issue_id").distinct()
    for lookup in lookups:
        names = names.join(lookup, lookup.columns[0], "left")
    found = [name for name in names.columns if name not in ("issue_id", *keys)]
    names = names.select(F.col("issue_id").alias("__issue"), F.struct(*keys).alias("__of"), *found)
    # The keys are compared inside an array, so that only the issue decides the partitioning.
    same = (F.col("issue_id") == F.col("__issue")) & F.array_contains(F.array("__of"), F.struct(*keys))
    return rows.join(names, same, "left").drop("__issue", "__of")


def fct_issue(
    issues: DataFrame,
    projects: DataFrame,
    issue_types: DataFrame,
    dim_status: DataFrame,
    priorities: DataFrame,
    resolutions: DataFrame,
    users: DataFrame,
    epics: DataFrame,
    sprint_of_issue: DataFrame,
    dim_sprint: DataFrame,
    started: DataFrame,
    config: LayerConfig,
) -> DataFrame:
    """One wide row per issue with its lookups, epic, current sprint and times.

    Names are looked up on narrow rows, the issue and its keys, which are dealt by issue
    before.  So the wide rows with their summaries and labels are shuffled once, by issue,
    however large the lookups are, and all that is keyed by issue shares that partitioning:
    names of lookups that Spark broadcasts are never shuffled.  Users come first, as they may
    be too many for that: then rows travel to them before other names make these wide.
    """
    sprint_names = _lookup(
        dim_sprint, "sprint_id", current_sprint_id="sprint_id", current_sprint_name="sprint_name"
    )
    lookups = (
        _lookup(users, "account_id", assignee_id="account_id", assignee_name="display_name"),
        _lookup(users, "account_id", reporter_id="account_id", reporter_name="display_name"),
        _lookup(projects, "id", project_id="id", project_key="project_key", project_name="name"),
        _lookup(issue_types, "id", issue_type_id="id", issue_type="name"),
        _lookup(
            dim_status,
            "status_id",
            status_id="status_id",
            status_name="status_name",
            status_category_key="category_key",
            status_category="category_name",
        ),
        _lookup(priorities, "id", priority_id="id", priority="name"),
        _lookup(resolutions, "id", resolution_id="id", resolution="name"),
    )
    issues = issues.withColumnRenamed("id", "issue_id")
    rows = (
        issues.join(epics, "issue_id", "left")
        .join(sprint_of_issue.join(sprint_names, "current_sprint_id", "left"), "issue_id", "left")
        .join(started.withColumnRenamed("started_at", "first_in_progress_at"), "issue_id", "left")
    )
    return issue_times(_with_names(rows, issues, lookups), config).select(*ISSUE_FACT_LAYOUT)


def status_changes(history: DataFrame, config: LayerConfig, largest: int | None = None) -> DataFrame:
    """Status values per issue in time order, with the one before and the exit time.

    ``largest`` is a bound of the changes of one issue, where it is known.
    """
    return with_neighbours(
        status_history(history, config),
        key="issue_id",
        time="updated_at",
        ties=["value"],
        following={"exited_at": "updated_at"},
        preceding={"prev_status_id_raw": "value"},
        largest=largest,
    ).select(
        "issue_id",
        F.col("value").alias("status_id_raw"),
        F.col("updated_at").alias("entered_at"),
        "exited_at",
        "prev_status_id_raw",
    )


def fct_issue_transitions(
    changes: DataFrame, issues: DataFrame, statuses: DataFrame, categories: DataFrame
) -> DataFrame:
    """One row per status an issue entered; the duration is the time spent in it."""
    keys = categories.select(
        F.col("id").alias("status_category_id"), F.col("category_key").alias("to_category_key")
    )
    left_behind = statuses.select(F.col("id").alias("__from"), F.col("name").alias("from_status"))
    entered = statuses.join(keys, "status_category_id", "left").select(
        F.col("id").alias("__to"), F.col("name").alias("to_status"), "to_category_key"
    )
    owners = issues.select(F.col("id").alias("issue_id"), "project_id", "issue_key")
    seconds = F.unix_timestamp("exited_at") - F.unix_timestamp("entered_at")
    return (
        changes.withColumns(
            {
                "__from": F.col("prev_status_id_raw").try_cast("bigint"),
                "__to": F.col("status_id_raw").try_cast("bigint"),
            }
        )
        .join(left_behind, "__from", "left")
        .join(entered, "__to", "left")
        .join(owners, "issue_id", "left")
        .select(
            "issue_id",
            "project_id",
            "issue_key",
            F.col("prev_status_id_raw").alias("from_status_id"),
            "from_status",
            F.col("status_id_raw").alias("to_status_id"),
            "to_status",
            "to_category_key",
            "entered_at",
            "exited_at",
            hours(seconds).alias("duration_hours"),
        )
    )


def fct_sprint_velocity(
    sprint_issues: DataFrame,
    sprints: DataFrame,
    issues: DataFrame,
    boards: DataFrame,
    projects: DataFrame,
) -> DataFrame:
    """Planned and completed issues and points per sprint.

    Membership rows are reduced to one row per sprint before board and project
    are attached.  Completed means resolved by the end of the sprint, however
    early.
    """
    ends = sprints.select(F.col("id").alias("sprint_id"), sprint_end().alias("sprint_end"))
    outcomes = issues.select(F.col("id").alias("issue_id"), "story_points", "resolved_at")
    done = F.col("resolved_at") <= F.col("sprint_end")
    planned = F.sum("story_points")
    completed = F.coalesce(F.sum(F.when(done, F.col("story_points"))), F.lit(0.0))
    totals = (
        sprint_issues.join(ends, "sprint_id")
        .join(outcomes, "issue_id", "left")
        .groupBy("sprint_id")
        .agg(
            F.count_distinct("issue_id").alias("issues_in_sprint"),
            F.count_if(done).alias("issues_completed"),
            F.coalesce(planned, F.lit(0.0)).alias("points_in_sprint"),
            completed.alias("points_completed"),
            F.when(F.coalesce(planned, F.lit(0.0)) > 0, completed / planned).alias(
                "completion_ratio"
            ),
        )
    )
    owners = (
        boards.select(F.col("id").alias("board_id"), "project_id")
        .join(
            projects.select(F.col("id").alias("project_id"), "project_key"), "project_id", "left"
        )
    )
    attributes = (
        sprints.withColumnsRenamed({"id": "sprint_id", "name": "sprint_name"})
        .join(owners, "board_id", "left")
        .select(
            "sprint_id",
            "sprint_name",
            "state",
            "start_date",
            "complete_date",
            "end_date",
            "goal",
            "board_id",
            "project_id",
            "project_key",
        )
    )
    return attributes.join(totals, "sprint_id").select(*attributes.columns, *totals.columns[1:])


def fct_worklog(
    worklogs: DataFrame, issues: DataFrame, projects: DataFrame, users: DataFrame
) -> DataFrame:
    """Worklog entries with their issue, project and author."""
    owners = issues.select(F.col("id").alias("issue_id"), "issue_key", "project_id")
    named_projects = projects.select(
        F.col("id").alias("project_id"), "project_key", F.col("name").alias("project_name")
    )
    authors = users.select(
        F.col("account_id").alias("author_id"), F.col("display_name").alias("author_name")
    )
    return (
        worklogs.withColumnRenamed("id", "worklog_id")
        .join(owners.join(named_projects, "project_id", "left"), "issue_id", "left")
        .join(authors, "author_id", "left")
        .select(
            "worklog_id",
            "issue_id",
            "issue_key",
            "project_id",
            "project_key",
            "project_name",
            "author_id",
            "author_name",
            "time_spent_seconds",
            hours(F.col("time_spent_seconds")).alias("time_spent_hours"),
            "started_at",
            "created_at",
            "updated_at",
            F.col("started_at").cast("date").alias("work_date"),
        )
    )


def grain_check(facts: DataFrame) -> DataFrame:
    """Issue ids that occur more than once in the issue fact."""
    counted = facts.groupBy("issue_id").agg(F.count(F.lit(1)).alias("copies"))
    return counted.where(F.col("copies") > 1)
