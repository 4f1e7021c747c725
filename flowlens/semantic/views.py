"""The nine metric views over the gold tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlens.config import LayerConfig
from flowlens.functions.times import percentile
from flowlens.operators.aggregates import CRITICAL_PRIORITIES, STALE_AFTER_DAYS
from flowlens.semantic import states
from flowlens.semantic.model import Field, Join, Measure, MetricView, source
from flowlens.semantic.summary import Summary

# Names of priority bands and the priorities in each.
PRIORITY_BANDS = {
    "Critical": CRITICAL_PRIORITIES,
    "High": ("High",),
    "Medium": ("Medium", "Major"),
}
OTHER_PRIORITY_BAND = "Low / Other"

# Age buckets that count as stale load.
STALE_BUCKETS = ("30-90d", "90d+")

# Type of exact hours where a sketch gives them back.
HOURS = "decimal(38,6)"


def _field(name: str, column: str | Column, *synonyms: str) -> Field:
    """A field on a source column, or on ``join.column`` of a joined table."""
    if isinstance(column, Column):
        return Field(name, column, None, synonyms)
    join, dot, _ = column.partition(".")
    return Field(name, F.col(column) if dot else source(column), join if dot else None, synonyms)


def _measure(name: str, expression: Column, *synonyms: str) -> Measure:
    return Measure(name, expression, synonyms)


def _rows() -> Column:
    return F.count(F.lit(1))


def _sum(column: str) -> Column:
    return F.sum(source(column))


def _avg(column: str) -> Column:
    return F.avg(source(column))


def _sum_where(condition: Column, column: str) -> Column:
    return F.sum(F.when(condition, source(column)).otherwise(F.lit(0)))


def _counted(name: str, *synonyms: str, where: Column | None = None) -> Measure:
    expression = _rows() if where is None else F.count_if(where)
    return Measure(name, expression, synonyms, states.count(expression))


def _summed(name: str, column: str, *synonyms: str, where: Column | None = None) -> Measure:
    if where is None:
        return Measure(name, _sum(column), synonyms, states.total(source(column)))
    values = F.when(where, source(column)).otherwise(F.lit(0))
    return Measure(name, F.sum(values), synonyms, states.total(values))


def _averaged(name: str, column: str, *synonyms: str) -> Measure:
    return Measure(name, _avg(column), synonyms, states.mean(source(column)))


def _ranked(name: str, column: str, share: float, kind: str, *synonyms: str) -> Measure:
    """A percentile; its state is a sketch, the measure itself stays the direct one."""
    values = source(column)
    return Measure(name, percentile(values, share), synonyms, states.quantile(values, share, kind))


def _month(column: str) -> Column:
    return F.date_trunc("MONTH", source(column))


def _week(column: str) -> Column:
    return F.date_trunc("WEEK", source(column))


def _day(column: str) -> Column:
    return source(column).cast("date")


def _priority_band() -> Column:
    (first, members), *rest = PRIORITY_BANDS.items()
    band = F.when(source("priority").isin(*members), first)
    for name, members in rest:
        band = band.when(source("priority").isin(*members), name)
    return band.otherwise(OTHER_PRIORITY_BAND)


def _project_join() -> Join:
    return Join("project_dim", "dim_project", source("project_id"), "project_id")


def _user_join(name: str, key: str) -> Join:
    return Join(name, "dim_user", source(key), "account_id")


# Fixed values, here and in the views below: names and synonyms of fields and measures.
def issue_view(config: LayerConfig) -> MetricView:
    resolved = source("is_resolved")
    unresolved = ~resolved
    critical = source("priority").isin(*CRITICAL_PRIORITIES)
    unassigned = source("assignee_id").isNull()
    due = _day("due_date")
    overdue = unresolved & due.isNotNull() & (due < config.today())
    wip = unresolved & (source("status_category_key") == "indeterminate")

    def since(column: str, days: int) -> Column:
        return source(column) >= config.days_ago(days)

    return MetricView(
        name="metric_issue",
        table="fct_issue",
        condition=source("issue_id").isNotNull(),
        joins=(
            _project_join(),
            _user_join("assignee_dim", "assignee_id"),
            _user_join("reporter_dim", "reporter_id"),
            Join("status_dim", "dim_status", source("status_id"), "status_id"),
            Join("sprint_dim", "dim_sprint", source("current_sprint_id"), "sprint_id"),
        ),
        fields=(
            _field("Issue Key", "issue_key", "ticket", "key"),
            _field("Summary", "summary"),
            _field("Project Key", "project_key", "project", "proj"),
            _field("Project Name", "project_name"),
            _field("Project Lead", "project_dim.lead_name", "project owner", "lead"),
            _field("Project Category", "project_dim.category_name"),
            _field("Project Type", "project_dim.project_type_key"),
            _field("Issue Type", "issue_type", "type"),
            _field("Status", "status_name"),
            _field("Status Category", "status_category", "category", "To Do In Progress Done"),
            _field("Status Category Order", "status_dim.category_order"),
            _field("Priority", "priority"),
            _field("Resolution", "resolution"),
            _field("Assignee", "assignee_name", "owner", "engineer"),
            _field("Assignee Email", "assignee_dim.email"),
            _field("Reporter Email", "reporter_dim.email"),
            _field("Current Sprint", "current_sprint_name", "sprint"),
            _field("Sprint State", "sprint_dim.state"),
            _field("Sprint Board", "sprint_dim.board_name"),
            _field("Age Bucket", "age_bucket"),
            _field("Age (days)", "age_days"),
            _field("Cycle Time (days)", "cycle_time_days"),
            _field("Lead Time (days)", "lead_time_days"),
            _field("Is Resolved", "is_resolved"),
            _field("Created Month", _month("created_at")),
            _field("Resolved Month", _month("resolved_at")),
            _field("Created Week", _week("created_at"), "week created"),
            _field("Resolved Week", _week("resolved_at"), "week resolved"),
            _field("Created Date", _day("created_at")),
            _field("Resolved Date", _day("resolved_at")),
            _field("Due Date", due),
            _field("Reporter", "reporter_name", "reporter name"),
            _field("Story Points", "story_points"),
            _field("Priority Group", _priority_band(), "severity band"),
            _field("Is Unassigned", unassigned),
            _field("Is Overdue", overdue),
            _field("Is WIP", wip, "in progress flag"),
        ),
        measures=(
            _counted("Issue Count", "total issues", "tickets"),
            _counted("Open Issues", "open", "backlog", where=unresolved),
            _counted("Resolved Issues", "closed", "done", where=resolved),
            _counted("Open Critical", "critical backlog", where=unresolved & critical),
            _counted(
                "Stale Open", "aging issues", "stale", where=unresolved & (source("age_days") > STALE_AFTER_DAYS)
            ),
            _counted("WIP Issues", "in progress", "work in progress", "wip", where=wip),
            _counted("To Do Issues", "todo", "to do", where=unresolved & (source("status_category_key") == "new")),
            _counted("Unassigned Open", "unassigned", "no owner", where=unresolved & unassigned),
            _counted("Overdue Open", "overdue", "past due", where=overdue),
            _counted("Created (7d)", "created last 7 days", "new issues this week", where=since("created_at", 7)),
            _counted("Created (30d)", "created last 30 days", "inflow", where=since("created_at", 30)),
            _counted("Created (90d)", where=since("created_at", 90)),
            _counted("Resolved (7d)", "resolved last 7 days", where=since("resolved_at", 7)),
            _counted(
                "Resolved (30d)", "resolved last 30 days", "outflow", "throughput", where=since("resolved_at", 30)
            ),
            _counted("Resolved (90d)", where=since("resolved_at", 90)),
            _averaged("Avg Cycle Time (days)", "cycle_time_days"),
            _ranked("Median Cycle Time (days)", "cycle_time_days", 0.5, "long", "p50 cycle time"),
            _ranked("P90 Cycle Time (days)", "cycle_time_days", 0.9, "long", "p90 cycle time"),
            _averaged("Avg Lead Time (days)", "lead_time_days"),
            _summed("Total Story Points", "story_points"),
            _summed("Open Story Points", "story_points", "backlog points", where=unresolved),
            _summed("Resolved Story Points", "story_points", where=resolved),
            _averaged("Avg Age (days)", "age_days"),
        ),
    )


def sprint_velocity_view() -> MetricView:
    return MetricView(
        name="metric_sprint_velocity",
        table="fct_sprint_velocity",
        joins=(
            _project_join(),
            Join("sprint_dim", "dim_sprint", source("sprint_id"), "sprint_id"),
        ),
        fields=(
            _field("Sprint", "sprint_name"),
            _field("Sprint State", "state", "active closed future"),
            _field("Project Key", "project_key", "project"),
            _field("Project Name", "project_dim.project_name"),
            _field("Project Lead", "project_dim.lead_name"),
            _field("Sprint Board", "sprint_dim.board_name"),
            _field("Start Date", "start_date"),
            _field("Complete Date", "complete_date"),
            _field("Complete Month", _month("complete_date")),
        ),
        measures=(
            _measure("Sprint Count", F.count_distinct(source("sprint_id"))),
            _measure("Points Planned", _sum("points_in_sprint"), "committed points"),
            _measure(
                "Points Completed", _sum("points_completed"), "velocity", "delivered points"
            ),
            _measure("Avg Completion Ratio", _avg("completion_ratio"), "completion rate"),
            _measure("Issues Planned", _sum("issues_in_sprint")),
            _measure("Issues Completed", _sum("issues_completed")),
            _measure(
                "Carryover Points",
                _sum("points_in_sprint") - _sum("points_completed"),
                "spillover points",
                "unfinished points",
            ),
            _measure(
                "Carryover Issues",
                _sum("issues_in_sprint") - _sum("issues_completed"),
                "spillover issues",
            ),
        ),
    )


def issue_transitions_view() -> MetricView:
    return MetricView(
        name="metric_issue_transitions",
        table="fct_issue_transitions",
        joins=(
            _project_join(),
            Join(
                "to_status_dim",
                "dim_status",
                source("to_status_id").try_cast("bigint"),
                "status_id",
            ),
        ),
        fields=(
            _field("Project Key", "project_dim.project_key", "project"),
            _field("Project Name", "project_dim.project_name"),
            _field("From Status", "from_status"),
            _field("To Status", "to_status", "status"),
            _field("To Status Category", "to_status_dim.category_name"),
            _field("To Category", "to_category_key"),
        ),
        measures=(
            _counted("Transition Count"),
            _averaged("Avg Duration (hours)", "duration_hours", "average time in status"),
            _ranked("Median Duration (hours)", "duration_hours", 0.5, HOURS, "p50 time in status"),
            _ranked("P90 Duration (hours)", "duration_hours", 0.9, HOURS, "p90 time in status"),
        ),
    )


def worklog_view(config: LayerConfig) -> MetricView:
    def recent(days: int) -> Column:
        return _sum_where(source("work_date") >= config.days_ago(days), "time_spent_hours")

    return MetricView(
        name="metric_worklog",
        table="fct_worklog",
        joins=(_project_join(), _user_join("author_dim", "author_id")),
        fields=(
            _field("Project Key", "project_key", "project"),
            _field("Project Name", "project_name"),
            _field("Project Lead", "project_dim.lead_name"),
            _field("Author", "author_name", "contributor", "engineer"),
            _field("Author Email", "author_dim.email"),
            _field("Work Date", "work_date"),
            _field("Work Month", _month("work_date")),
        ),
        measures=(
            _measure("Total Hours", _sum("time_spent_hours"), "logged hours", "effort"),
            _measure("Hours (7d)", recent(7), "hours last 7 days"),
            _measure("Hours (30d)", recent(30), "hours last 30 days", "recent effort"),
            _measure("Worklog Entries", _rows()),
            _measure(
                "Contributors", F.count_distinct(source("author_id")), "unique contributors"
            ),
            _measure("Avg Hours per Entry", _avg("time_spent_hours")),
        ),
    )


def project_health_view() -> MetricView:
    created = _sum("created_last_30d")
    resolved = _sum("resolved_last_30d")
    return MetricView(
        name="metric_project_health",
        table="agg_project_health",
        joins=(_project_join(),),
        fields=(
            _field("Project Key", "project_key", "project"),
            _field("Project Name", "project_name"),
            _field("Project Lead", "project_dim.lead_name"),
            _field("Project Category", "project_dim.category_name"),
        ),
        measures=(
            _measure("Total Issues", _sum("total_issues")),
            _measure("Open Issues", _sum("open_issues"), "open", "backlog"),
            _measure("Resolved Issues", _sum("resolved_issues")),
            _measure("Open Critical", _sum("open_critical"), "critical backlog"),
            _measure("Stale Open", _sum("stale_open"), "stale issues"),
            _measure("Avg Cycle Time (days)", _avg("avg_cycle_time_days")),
            _measure("Avg Lead Time (days)", _avg("avg_lead_time_days")),
            _measure("Resolved Issues (30d)", resolved, "resolved last 30 days"),
            _measure("Created Issues (30d)", created),
            _measure(
                "Net Backlog Change (30d)",
                created - resolved,
                "backlog growth",
                "net inflow",
                "created vs resolved",
            ),
            _measure(
                "Flow Ratio (30d)",
                resolved / F.nullif(created, F.lit(0)),
                "created vs resolved ratio",
                "throughput ratio",
            ),
        ),
    )


def assignee_load_view() -> MetricView:
    return MetricView(
        name="metric_assignee_load",
        table="agg_assignee_load",
        joins=(_user_join("assignee_dim", "assignee_id"), _project_join()),
        fields=(
            _field("Assignee", "assignee_name", "owner", "engineer"),
            _field("Assignee Email", "assignee_dim.email"),
            _field("Project Key", "project_key"),
            _field("Project Name", "project_dim.project_name"),
            _field("Priority", "priority"),
            _field("Age Bucket", "age_bucket"),
        ),
        measures=(
            _measure("Open Issues", _sum("open_issues")),
            _measure("Open Story Points", _sum("open_story_points")),
            _measure("Avg Age (days)", _avg("avg_age_days")),
            _measure(
                "Stale Open",
                _sum_where(source("age_bucket").isin(*STALE_BUCKETS), "open_issues"),
                "aging load",
                "stale load",
            ),
        ),
    )


def team_productivity_view() -> MetricView:
    active = (source("resolved_30d") > 0) | (source("open_now") > 0)
    return MetricView(
        name="metric_team_productivity",
        table="agg_team_productivity",
        joins=(_user_join("assignee_dim", "assignee_id"),),
        fields=(
            _field("Assignee", "assignee_name", "contributor", "engineer"),
            _field("Assignee Email", "assignee_dim.email"),
        ),
        measures=(
            _measure("Resolved (30d)", _sum("resolved_30d"), "resolved last 30 days"),
            _measure("Resolved (90d)", _sum("resolved_90d")),
            _measure("Open Now", _sum("open_now"), "current open load"),
            _measure("Open Critical", _sum("open_critical")),
            _measure("Avg Cycle Time (days)", _avg("avg_cycle_time_days")),
            _measure("Avg Lead Time (days)", _avg("avg_lead_time_days")),
            _measure("Active Contributors", F.count_if(active)),
        ),
    )


def time_in_status_view() -> MetricView:
    return MetricView(
        name="metric_time_in_status",
        table="agg_time_in_status",
        joins=(
            _project_join(),
            Join("status_dim", "dim_status", source("status_name"), "status_name"),
        ),
        fields=(
            _field("Project Key", "project_key"),
            _field("Project Name", "project_dim.project_name"),
            _field("Status", "status_name", "status name"),
            _field("Status Category", "status_dim.category_name"),
            _field("Status Category Key", "status_category_key"),
        ),
        measures=(
            _measure("Observations", _sum("observations")),
            _measure("P50 Duration (hours)", _avg("p50_hours"), "median time in status"),
            _measure("P90 Duration (hours)", _avg("p90_hours"), "p90 time in status"),
            _measure("Avg Duration (hours)", _avg("avg_hours")),
        ),
    )


def flow_view() -> MetricView:
    return MetricView(
        name="metric_flow",
        table="created_resolved_daily",
        condition=source("flow_date").isNotNull(),
        joins=(_project_join(),),
        fields=(
            _field("Flow Date", "flow_date", "date", "day"),
            _field("Flow Week", _week("flow_date"), "week"),
            _field("Flow Month", _month("flow_date"), "month"),
            _field("Project Key", "project_key", "project"),
            _field("Project Name", "project_name"),
            _field("Project Lead", "project_dim.lead_name"),
            _field("Project Category", "project_dim.category_name"),
        ),
        measures=(
            _measure("Created Issues", _sum("created_issues"), "created", "inflow", "opened"),
            _measure(
                "Resolved Issues", _sum("resolved_issues"), "resolved", "outflow", "closed", "done"
            ),
            _measure(
                "Net Backlog Change",
                _sum("net_backlog_change"),
                "backlog growth",
                "net change",
                "created minus resolved",
            ),
            _measure("Created Points", _sum("created_points"), "created story points"),
            _measure(
                "Resolved Points",
                _sum("resolved_points"),
                "resolved story points",
                "delivered points",
            ),
        ),
    )


def all_views(config: LayerConfig) -> dict[str, MetricView]:
    views = (
        issue_view(config),
        sprint_velocity_view(),
        issue_transitions_view(),
        worklog_view(config),
        project_health_view(),
        assignee_load_view(),
        team_productivity_view(),
        time_in_status_view(),
        flow_view(),
    )
    return {view.name: view for view in views}


# Days within which an issue counts as lately resolved.
LATELY_DAYS = 180


def summaries(config: LayerConfig) -> dict[str, Summary]:
    """What is kept of the two views over the largest facts.

    An issue summary has a row per project, type, priority, status category, resolution and
    recency; so its size follows these lists, not the number of issues.
    """
    first = config.days_ago(LATELY_DAYS)
    kept = (
        Summary(
            "issue",
            "issue",
            ("Project Key", "Project Name", "Issue Type", "Priority", "Status Category", "Is Resolved"),
            flags={"Lately Resolved": lambda f: f("Is Resolved") & (f("Resolved Date") >= first)},
            further={"Median Lead Time (days)": lambda f: states.quantile(f("Lead Time (days)"), 0.5, "long")},
        ),
        Summary(
            "issue_transitions",
            "issue_transitions",
            ("Project Key", "Project Name", "From Status", "To Status", "To Category"),
        ),
    )
    return {one.name: one for one in kept}
