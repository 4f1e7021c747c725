"""Report datasets: the fifteen result sets the delivery report is drawn from."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.times import CYCLE_BUCKETS, bucket, percentile
from flowlens.operators.aggregates import CRITICAL_PRIORITIES, STALE_AFTER_DAYS
from flowlens.semantic.layer import MetricLayer

# Windows of the report, in days, and sprints in the recent trend.
RECENT_DAYS = 30
RESOLVED_WINDOW_DAYS = 180
FLOW_WINDOW_DAYS = 84
RECENT_SPRINTS = 12

# Output labels of the issue rows and the fields behind them.
ISSUE_COLUMNS = {
    "issue_key": "Issue Key",
    "summary": "Summary",
    "project_key": "Project Key",
    "assignee_name": "Assignee",
    "priority": "Priority",
    "age_days": "Age (days)",
    "status_category": "Status Category",
    "issue_type": "Issue Type",
    "is_resolved": "Is Resolved",
    "cycle_time_days": "Cycle Time (days)",
    "lead_time_days": "Lead Time (days)",
    "age_bucket": "Age Bucket",
}

# Output labels of the sprint rows.
SPRINT_COLUMNS = {
    "sprint_name": "Sprint",
    "state": "Sprint State",
    "project_key": "Project Key",
    "start_date": "Start Date",
    "complete_date": "Complete Date",
}
SPRINT_TOTALS = {
    "points_in_sprint": "Points Planned",
    "points_completed": "Points Completed",
    "completion_ratio": "Avg Completion Ratio",
    "issues_in_sprint": "Issues Planned",
    "issues_completed": "Issues Completed",
}


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def as_series(frame: DataFrame, keys: list[str], names: dict[str, str], value: str) -> DataFrame:
    """Turn measure columns into rows labelled by ``series``, from one aggregation."""
    lines = [
        F.struct(F.lit(series).alias("series"), F.col(column).alias(value))
        for column, series in names.items()
    ]
    return frame.select(*keys, F.explode(F.array(*lines)).alias("line")).select(*keys, "line.*")


def _closed_sprint(f: Callable[[str], Column]) -> Column:
    return (f("Sprint State") == "closed") & f("Complete Date").isNotNull()


def velocity(layer: MetricLayer) -> DataFrame:
    recent = layer.config.days_ago(RECENT_DAYS)
    return layer.view("sprint_velocity").query(
        SPRINT_COLUMNS,
        SPRINT_TOTALS,
        derived={
            "is_active": lambda v: flag(v("Sprint State") == "active"),
            "points_completed_30d": lambda v: F.when(
                v("Complete Date") >= recent, v("Points Completed")
            ).otherwise(F.lit(0.0)),
        },
    )


def velocity_recent(layer: MetricLayer) -> DataFrame:
    return layer.view("sprint_velocity").query(
        SPRINT_COLUMNS,
        SPRINT_TOTALS,
        where=_closed_sprint,
        derived={"carryover_points": lambda v: v("Points Planned") - v("Points Completed")},
        order_by=["-complete_date", "sprint_name"],
        limit=RECENT_SPRINTS,
    )


def velocity_series(layer: MetricLayer) -> DataFrame:
    keys = {
        "sprint_name": "Sprint",
        "project_key": "Project Key",
        "complete_date": "Complete Date",
    }
    totals = layer.view("sprint_velocity").query(
        keys, ["Points Planned", "Points Completed"], where=_closed_sprint
    )
    names = {"Points Planned": "Planned", "Points Completed": "Completed"}
    return as_series(totals, list(keys), names, "points")


def issue(layer: MetricLayer) -> DataFrame:
    return layer.view("issue").rows(ISSUE_COLUMNS)


def issue_open(layer: MetricLayer) -> DataFrame:
    def stale(f: Callable[[str], Column]) -> Column:
        return f("Age (days)") > STALE_AFTER_DAYS

    return layer.view("issue").rows(
        ISSUE_COLUMNS,
        where=lambda f: ~f("Is Resolved"),
        derived={
            "is_stale_open": lambda f: flag(stale(f)),
            "is_stale_critical": lambda f: flag(
                stale(f) & f("Priority").isin(*CRITICAL_PRIORITIES)
            ),
            "is_unassigned": lambda f: flag(f("Is Unassigned")),
            "is_overdue": lambda f: flag(f("Is Overdue")),
            "is_wip": lambda f: flag(f("Is WIP")),
        },
    )


def issue_kpi(layer: MetricLayer) -> DataFrame:
    return layer.view("issue").query(
        {"project_key": "Project Key"},
        {
            "open_issues": "Open Issues",
            "open_critical": "Open Critical",
            "wip_issues": "WIP Issues",
            "unassigned_open": "Unassigned Open",
            "overdue_open": "Overdue Open",
            "created_30d": "Created (30d)",
            "resolved_30d": "Resolved (30d)",
        },
        derived={"net_backlog_30d": lambda v: v("Created (30d)") - v("Resolved (30d)")},
    )


def _lately_resolved(layer: MetricLayer) -> Callable[[Callable[[str], Column]], Column]:
    first = layer.config.days_ago(RESOLVED_WINDOW_DAYS)
    return lambda f: f("Is Resolved") & (f("Resolved Date") >= first)


def issue_resolved_180(layer: MetricLayer) -> DataFrame:
    return layer.view("issue").rows(
        ISSUE_COLUMNS,
        where=_lately_resolved(layer),
        derived={"cycle_bucket": lambda f: bucket(f("Cycle Time (days)"), CYCLE_BUCKETS)},
    )


def issue_medians(layer: MetricLayer) -> DataFrame:
    return layer.view("issue").query(
        {"project_key": "Project Key"},
        where=_lately_resolved(layer),
        adhoc={
            "median_cycle": lambda f: percentile(f("Cycle Time (days)"), 0.5),
            "median_lead": lambda f: percentile(f("Lead Time (days)"), 0.5),
        },
    )


def project_health(layer: MetricLayer) -> DataFrame:
    return layer.view("project_health").query(
        {"project_key": "Project Key", "project_name": "Project Name"},
        {
            "open_issues": "Open Issues",
            "open_critical": "Open Critical",
            "stale_open": "Stale Open",
            "avg_cycle_time_days": "Avg Cycle Time (days)",
            "resolved_last_30d": "Resolved Issues (30d)",
            "created_last_30d": "Created Issues (30d)",
            "net_backlog_30d": "Net Backlog Change (30d)",
            "flow_ratio_30d": "Flow Ratio (30d)",
        },
        derived={"has_stale": lambda v: flag(v("Stale Open") > 0)},
    )


def assignee_load(layer: MetricLayer) -> DataFrame:
    return layer.view("assignee_load").query(
        {"assignee_name": "Assignee", "project_key": "Project Key", "priority": "Priority"},
        {"open_issues": "Open Issues"},
    )


def team_prod(layer: MetricLayer) -> DataFrame:
    return layer.view("team_productivity").query(
        {"assignee_name": "Assignee"},
        {
            "resolved_30d": "Resolved (30d)",
            "resolved_90d": "Resolved (90d)",
            "open_now": "Open Now",
            "open_critical": "Open Critical",
            "avg_cycle_time_days": "Avg Cycle Time (days)",
            "avg_lead_time_days": "Avg Lead Time (days)",
        },
        derived={
            "is_active_contributor": lambda v: flag(
                (v("Resolved (30d)") > 0) | (v("Open Now") > 0)
            )
        },
    )


def time_in_status(layer: MetricLayer) -> DataFrame:
    return layer.view("time_in_status").query(
        {"project_key": "Project Key", "status_name": "Status"},
        {
            "p50_hours": "P50 Duration (hours)",
            "p90_hours": "P90 Duration (hours)",
            "observations": "Observations",
        },
    )


def _weekly_flow(layer: MetricLayer, measures: dict[str, str]) -> DataFrame:
    return layer.flow_since(layer.config.days_ago(FLOW_WINDOW_DAYS)).query(
        {"flow_week": "Flow Week", "project_key": "Project Key"}, measures
    )


def flow_weekly(layer: MetricLayer) -> DataFrame:
    return _weekly_flow(
        layer,
        {
            "created_issues": "Created Issues",
            "resolved_issues": "Resolved Issues",
            "net_change": "Net Backlog Change",
        },
    )


def flow_series(layer: MetricLayer) -> DataFrame:
    totals = _weekly_flow(layer, {"created": "Created Issues", "resolved": "Resolved Issues"})
    names = {"created": "Created", "resolved": "Resolved"}
    return as_series(totals, ["flow_week", "project_key"], names, "issues")


def issue_medians_merged(layer: MetricLayer) -> DataFrame:
    """The medians of lately resolved issues from the stored summary, without the issues."""
    return layer.summary("issue").query(
        {"project_key": "Project Key"},
        {"median_cycle": "Median Cycle Time (days)", "median_lead": "Median Lead Time (days)"},
        where=lambda f: f("Lately Resolved"),
    )


def worklog(layer: MetricLayer) -> DataFrame:
    return layer.view("worklog").query(
        {"project_key": "Project Key", "author_name": "Author"},
        {"hours_30d": "Hours (30d)", "total_hours": "Total Hours"},
    )


DATASETS: dict[str, Callable[[MetricLayer], DataFrame]] = {
    "ds_velocity": velocity,
    "ds_velocity_recent": velocity_recent,
    "ds_velocity_series": velocity_series,
    "ds_issue": issue,
    "ds_issue_open": issue_open,
    "ds_issue_kpi": issue_kpi,
    "ds_issue_resolved_180": issue_resolved_180,
    "ds_issue_medians": issue_medians,
    "ds_project_health": project_health,
    "ds_assignee_load": assignee_load,
    "ds_team_prod": team_prod,
    "ds_time_in_status": time_in_status,
    "ds_flow_weekly": flow_weekly,
    "ds_flow_series": flow_series,
    "ds_worklog": worklog,
}


@dataclass(frozen=True)
class Slice:
    """A dataset's rows as a condition on the rows of a view; none means all of them.

    ``columns`` maps the dataset's columns to the view's fields that a selector may offer.
    """

    view: str
    columns: Mapping[str, str]
    where: Callable[[MetricLayer], Callable[[Callable[[str], Column]], Column]] | None = None


def _lately_moved(layer: MetricLayer) -> Callable[[Callable[[str], Column]], Column]:
    """Issues created or resolved within the flow's window."""
    first = layer.config.days_ago(FLOW_WINDOW_DAYS)
    return lambda f: (f("Created Date") >= first) | (f("Is Resolved") & (f("Resolved Date") >= first))


def _unresolved(layer: MetricLayer) -> Callable[[Callable[[str], Column]], Column]:
    return lambda f: ~f("Is Resolved")


_PROJECT = {"project_key": "Project Key"}

# Datasets whose selector values need no more than a condition on a view.
SLICES: dict[str, Slice] = {
    "ds_velocity": Slice("sprint_velocity", _PROJECT),
    "ds_velocity_series": Slice("sprint_velocity", _PROJECT, lambda layer: _closed_sprint),
    "ds_issue": Slice("issue", _PROJECT),
    "ds_issue_open": Slice("issue", _PROJECT, _unresolved),
    "ds_issue_kpi": Slice("issue", _PROJECT),
    "ds_issue_resolved_180": Slice("issue", _PROJECT, _lately_resolved),
    "ds_issue_medians": Slice("issue", _PROJECT, _lately_resolved),
    "ds_project_health": Slice("project_health", _PROJECT),
    "ds_assignee_load": Slice("assignee_load", {"project_key": "Project Key", "assignee_name": "Assignee"}),
    "ds_team_prod": Slice("team_productivity", {"assignee_name": "Assignee"}),
    "ds_time_in_status": Slice("time_in_status", _PROJECT),
    "ds_flow_weekly": Slice("issue", _PROJECT, _lately_moved),
    "ds_flow_series": Slice("issue", _PROJECT, _lately_moved),
    "ds_worklog": Slice("worklog", _PROJECT),
}


@dataclass(frozen=True)
class Fold:
    """A dataset's totals per project as aggregates of a view, with its row filter inside them.

    ``measures`` maps the dataset's columns to measures of the view, ``totals`` to aggregates
    over its fields.  Datasets folded over one view share one scan and one aggregation.
    """

    view: str
    measures: Mapping[str, str]
    totals: Mapping[str, Callable[[MetricLayer], Callable[[Callable[[str], Column]], Column]]]
    # Aggregates over the dataset's rows that may be taken over its totals per project.
    allowed: tuple[str, ...]
    # Columns computed from measures.
    derived: Mapping[str, Callable[[Callable[[str], Column]], Column]] = field(default_factory=dict)


def _median_of(name: str) -> Callable[[MetricLayer], Callable[[Callable[[str], Column]], Column]]:
    def build(layer: MetricLayer) -> Callable[[Callable[[str], Column]], Column]:
        kept = _lately_resolved(layer)
        return lambda f: percentile(F.when(kept(f), f(name)), 0.5)

    return build


def _open_flag(condition: Callable[[Callable[[str], Column]], Column]):
    return lambda layer: lambda f: F.sum(F.when(~f("Is Resolved"), flag(condition(f))))


def _stale(f: Callable[[str], Column]) -> Column:
    return f("Age (days)") > STALE_AFTER_DAYS


# Datasets over the issue view, whose counters come from one aggregation by project.
FOLDS: dict[str, Fold] = {
    "ds_issue_kpi": Fold(
        "issue",
        {
            "open_issues": "Open Issues",
            "open_critical": "Open Critical",
            "wip_issues": "WIP Issues",
            "unassigned_open": "Unassigned Open",
            "overdue_open": "Overdue Open",
            "created_30d": "Created (30d)",
            "resolved_30d": "Resolved (30d)",
        },
        {},
        ("SUM", "MAX", "MIN", "AVG"),
        {"net_backlog_30d": lambda v: v("Created (30d)") - v("Resolved (30d)")},
    ),
    "ds_issue_medians": Fold(
        "issue",
        {},
        {"median_cycle": _median_of("Cycle Time (days)"), "median_lead": _median_of("Lead Time (days)")},
        ("SUM", "MAX", "MIN", "AVG"),
    ),
    "ds_issue_open": Fold(
        "issue",
        {},
        {
            "is_stale_open": _open_flag(_stale),
            "is_stale_critical": _open_flag(lambda f: _stale(f) & f("Priority").isin(*CRITICAL_PRIORITIES)),
            "is_unassigned": _open_flag(lambda f: f("Is Unassigned")),
            "is_overdue": _open_flag(lambda f: f("Is Overdue")),
            "is_wip": _open_flag(lambda f: f("Is WIP")),
        },
        ("SUM",),
    ),
}
