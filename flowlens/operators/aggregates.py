"""Gold aggregates over the facts, and the daily created-versus-resolved flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.config import LayerConfig
from flowlens.functions.times import percentile

# Priorities that count as critical.
CRITICAL_PRIORITIES = ("Highest", "Critical", "Blocker")
STALE_AFTER_DAYS = 30


def is_open() -> Column:
    return ~F.col("is_resolved")


def is_critical() -> Column:
    return F.col("priority").isin(*CRITICAL_PRIORITIES)


def is_stale() -> Column:
    return F.col("age_days") > STALE_AFTER_DAYS


def since(column: str, days: int, config: LayerConfig) -> Column:
    """True from ``days`` before today on, with no upper bound."""
    return F.col(column) >= config.days_ago(days)


def _mean_of_resolved(column: str) -> Column:
    return F.avg(F.when(F.col("is_resolved"), F.col(column))).alias(f"avg_{column}")


def agg_assignee_load(facts: DataFrame) -> DataFrame:
    assigned = facts.where(is_open() & F.col("assignee_id").isNotNull())
    return assigned.groupBy(
        "assignee_id", "assignee_name", "project_id", "project_key", "priority", "age_bucket"
    ).agg(
        F.count(F.lit(1)).alias("open_issues"),
        F.avg("age_days").alias("avg_age_days"),
        F.sum(F.coalesce("story_points", F.lit(0.0))).alias("open_story_points"),
    )


def agg_project_health(facts: DataFrame, config: LayerConfig) -> DataFrame:
    return facts.groupBy("project_id", "project_key", "project_name").agg(
        F.count(F.lit(1)).alias("total_issues"),
        F.count_if(is_open()).alias("open_issues"),
        F.count_if(F.col("is_resolved")).alias("resolved_issues"),
        F.count_if(is_open() & is_critical()).alias("open_critical"),
        F.count_if(is_open() & is_stale()).alias("stale_open"),
        _mean_of_resolved("cycle_time_days"),
        _mean_of_resolved("lead_time_days"),
        F.count_if(since("resolved_at", 30, config)).alias("resolved_last_30d"),
        F.count_if(since("created_at", 30, config)).alias("created_last_30d"),
    )


def agg_team_productivity(facts: DataFrame, config: LayerConfig) -> DataFrame:
    assigned = facts.where(F.col("assignee_id").isNotNull())
    return assigned.groupBy("assignee_id", "assignee_name").agg(
        F.count_if(since("resolved_at", 30, config)).alias("resolved_30d"),
        F.count_if(since("resolved_at", 90, config)).alias("resolved_90d"),
        F.count_if(is_open()).alias("open_now"),
        _mean_of_resolved("cycle_time_days"),
        _mean_of_resolved("lead_time_days"),
        F.count_if(is_open() & is_critical()).alias("open_critical"),
    )


def agg_time_in_status(transitions: DataFrame, projects: DataFrame) -> DataFrame:
    """Distribution of the time spent per project and status.

    The project key is attached to the aggregated rows.
    """
    duration = F.col("duration_hours")
    groups = (
        transitions.where(duration.isNotNull())
        .groupBy("project_id", "to_status", "to_category_key")
        .agg(
            F.count(F.lit(1)).alias("observations"),
            percentile(duration, 0.5).alias("p50_hours"),
            percentile(duration, 0.9).alias("p90_hours"),
            F.avg(duration).alias("avg_hours"),
        )
    )
    keys = projects.select(F.col("id").alias("project_id"), "project_key")
    return groups.join(keys, "project_id", "left").select(
        "project_id",
        "project_key",
        F.col("to_status").alias("status_name"),
        F.col("to_category_key").alias("status_category_key"),
        "observations",
        "p50_hours",
        "p90_hours",
        "avg_hours",
    )


def created_resolved_daily(facts: DataFrame, first_day: Column | None = None) -> DataFrame:
    """Created and resolved issues and points per day and project.

    Each issue is up to two events, so one scan and one sum over the events give both
    sides.  With ``first_day`` older events are left out, and issues without any later
    one in the scan itself.  A project that goes by several keys or names has a row for
    each pair of a created and a resolved spelling of a day; with one spelling, or on days
    of one kind only, that is a row for each.
    """
    was_created, was_resolved = F.col("created_at").cast("date"), F.col("resolved_at").cast("date")
    done = F.col("is_resolved")
    if first_day is not None:
        facts = facts.where((was_created >= first_day) | (done & (was_resolved >= first_day)))
    points = F.coalesce("story_points", F.lit(0.0))
    event = lambda day, created, resolved: F.struct(
        day.alias("flow_date"),
        F.lit(created).cast("long").alias("created_issues"),
        F.lit(resolved).cast("long").alias("resolved_issues"),
        (points * created).alias("created_points"),
        (points * resolved).alias("resolved_points"),
    )
    events = F.array(event(was_created, 1, 0), F.when(done, event(was_resolved, 0, 1)))
    spelling = ["project_key", "project_name"]
    rows = facts.select("project_id", *spelling, F.inline(F.array_compact(events)))
    if first_day is not None:
        rows = rows.where(F.col("flow_date") >= first_day)
    totals = ["created_issues", "resolved_issues", "created_points", "resolved_points"]
    sums = rows.groupBy("flow_date", "project_id", *spelling).agg(*[F.sum(name).alias(name) for name in totals])

    # One row per day, project and spelling is left, so this is small.
    days = sums.groupBy("flow_date", "project_id").agg(F.collect_list(F.struct(*spelling, *totals)).alias("of"))
    created = F.filter("of", lambda one: one.created_issues > 0)
    resolved = F.filter("of", lambda one: one.resolved_issues > 0)
    paired = F.flatten(
        F.transform(
            created,
            lambda one: F.transform(
                resolved,
                lambda other: one.withField("resolved_issues", other.resolved_issues).withField(
                    "resolved_points", other.resolved_points
                ),
            ),
        )
    )
    lines = F.when((F.size(created) > 0) & (F.size(resolved) > 0), paired).otherwise(F.col("of"))
    return days.select("flow_date", "project_id", F.inline(lines)).select(
        "flow_date",
        "project_id",
        *spelling,
        *totals,
        (F.col("created_issues") - F.col("resolved_issues")).alias("net_backlog_change"),
    )
