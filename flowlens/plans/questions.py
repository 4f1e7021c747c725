"""Questions people ask of the metric views, as queries.

Where a ranking is cut off, the group key breaks ties, so the rows are the same
on every run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.plans.datasets import FLOW_WINDOW_DAYS
from flowlens.semantic.layer import MetricLayer

TOP = 10


def open_critical(layer: MetricLayer) -> DataFrame:
    return layer.view("project_health").query(
        ["Project Key"],
        {"open_critical": "Open Critical"},
        order_by=["-open_critical", "Project Key"],
        limit=TOP,
    )


def velocity_last_sprints(layer: MetricLayer, sprints: int = 5) -> DataFrame:
    return layer.view("sprint_velocity").query(
        ["Sprint"],
        {"velocity": "Points Completed"},
        where=lambda f: f("Sprint State") == "closed",
        grouped_by=["Complete Date"],
        order_by=["-Complete Date", "Sprint"],
        limit=sprints,
    )


def top_hours(layer: MetricLayer) -> DataFrame:
    return layer.view("worklog").query(
        ["Author"], {"hours": "Total Hours"}, order_by=["-hours", "Author"], limit=TOP
    )


def median_cycle(layer: MetricLayer) -> DataFrame:
    return layer.view("issue").query(
        ["Project Key"],
        {"median_cycle": "Median Cycle Time (days)"},
        where=lambda f: f("Is Resolved"),
        order_by=["-median_cycle", "Project Key"],
    )


def p90_in_status(layer: MetricLayer, status: str = "In Review") -> DataFrame:
    return layer.view("issue_transitions").query(
        ["Project Key"],
        {"p90_hours": "P90 Duration (hours)"},
        where=lambda f: f("To Status") == status,
        order_by=["-p90_hours", "Project Key"],
    )


def velocity_by_lead(layer: MetricLayer) -> DataFrame:
    return layer.view("sprint_velocity").query(
        ["Project Lead", "Project Key"],
        {"velocity": "Points Completed"},
        where=lambda f: f("Sprint State") == "closed",
        order_by=["-velocity", "Project Key"],
    )


def points_by_email(layer: MetricLayer) -> DataFrame:
    return layer.view("assignee_load").query(
        ["Assignee Email"],
        {"points": "Open Story Points", "issues": "Open Issues"},
        order_by=["-points", "Assignee Email"],
        limit=TOP,
    )


def slowest_in_status(layer: MetricLayer, status: str = "In Progress") -> DataFrame:
    return layer.view("time_in_status").query(
        ["Project Name", "Status"],
        {"p90_hours": "P90 Duration (hours)"},
        where=lambda f: f("Status") == status,
        order_by=["-p90_hours", "Project Name"],
    )


def flow_by_week(layer: MetricLayer) -> DataFrame:
    return layer.view("flow").query(
        ["Flow Week"],
        {
            "created": "Created Issues",
            "resolved": "Resolved Issues",
            "net_change": "Net Backlog Change",
        },
        order_by=["Flow Week"],
    )


def wip_unassigned(layer: MetricLayer) -> DataFrame:
    return layer.view("issue").query(
        (), {"wip": "WIP Issues", "unassigned": "Unassigned Open", "overdue": "Overdue Open"}
    )


def growing_backlog(layer: MetricLayer) -> DataFrame:
    return layer.view("project_health").query(
        ["Project Key"],
        {"net_change": "Net Backlog Change (30d)", "flow_ratio": "Flow Ratio (30d)"},
        order_by=["-net_change", "Project Key"],
    )


def top_resolvers(layer: MetricLayer) -> DataFrame:
    return layer.view("team_productivity").query(
        ["Assignee"],
        {"resolved": "Resolved (30d)"},
        order_by=["-resolved", "Assignee"],
        limit=TOP,
    )


def median_cycle_monthly(layer: MetricLayer, project: str) -> DataFrame:
    return layer.view("issue").query(
        ["Resolved Month"],
        {"median_cycle": "Median Cycle Time (days)", "resolved": "Resolved Issues"},
        where=lambda f: f("Is Resolved") & (f("Project Key") == project),
        order_by=["Resolved Month"],
    )


def oldest_bugs(layer: MetricLayer) -> DataFrame:
    bugs = layer.view("issue").rows(
        ["Issue Key", "Summary", "Project Key", "Assignee", "Age (days)"],
        where=lambda f: ~f("Is Resolved") & (f("Issue Type") == "Bug"),
    )
    return bugs.orderBy(F.col("Age (days)").desc_nulls_last(), "Issue Key").limit(TOP)


def quarter_points(layer: MetricLayer) -> DataFrame:
    first = F.date_trunc("QUARTER", layer.config.today())
    return layer.view("sprint_velocity").query(
        ["Project Key"],
        {"planned": "Points Planned", "completed": "Points Completed"},
        where=lambda f: (f("Sprint State") == "closed") & (f("Complete Date") >= first),
        order_by=["Project Key"],
    )


def worst_ratio(layer: MetricLayer) -> DataFrame:
    return layer.view("sprint_velocity").query(
        ["Sprint", "Project Key"],
        {"ratio": "Avg Completion Ratio"},
        where=lambda f: f("Sprint State") == "closed",
        order_by=["ratio", "Sprint"],
        limit=TOP,
    )


def hours_90d(layer: MetricLayer) -> DataFrame:
    first = layer.config.days_ago(90)
    return layer.view("worklog").query(
        ["Author"],
        {"hours": "Total Hours"},
        where=lambda f: f("Work Date") >= first,
        order_by=["-hours", "Author"],
        limit=TOP,
    )


def age_distribution(layer: MetricLayer) -> DataFrame:
    return layer.view("issue").query(
        ["Age Bucket"],
        {"open_issues": "Open Issues"},
        where=lambda f: ~f("Is Resolved"),
        order_by=["Age Bucket"],
    )


def backlog_12w(layer: MetricLayer) -> DataFrame:
    return layer.flow_since(layer.config.days_ago(FLOW_WINDOW_DAYS)).query(
        ["Flow Week"], {"net_change": "Net Backlog Change"}, order_by=["Flow Week"]
    )


def overloaded(layer: MetricLayer) -> DataFrame:
    return layer.view("team_productivity").query(
        ["Assignee"],
        {"open_now": "Open Now", "avg_cycle": "Avg Cycle Time (days)"},
        derived={
            "load_per_cycle_day": lambda v: v("Open Now") / F.nullif(
                v("Avg Cycle Time (days)"), F.lit(0.0)
            )
        },
        having=lambda v: v("Open Now") > 0,
        order_by=["-load_per_cycle_day", "Assignee"],
    )


def average_in_status(layer: MetricLayer, status: str = "In Review") -> DataFrame:
    return layer.view("time_in_status").query(
        ["Status"],
        {"avg_hours": "Avg Duration (hours)", "observations": "Observations"},
        where=lambda f: f("Status") == status,
    )


# Questions that need no argument; ``median_cycle_monthly`` asks for a project.
QUESTIONS: dict[str, Callable[[MetricLayer], DataFrame]] = {
    "q_open_critical": open_critical,
    "q_velocity_last5": velocity_last_sprints,
    "q_top_hours": top_hours,
    "q_median_cycle": median_cycle,
    "q_p90_in_review": p90_in_status,
    "q_velocity_by_lead": velocity_by_lead,
    "q_points_by_email": points_by_email,
    "q_slowest_in_progress": slowest_in_status,
    "q_flow_by_week": flow_by_week,
    "q_wip_unassigned": wip_unassigned,
    "q_growing_backlog": growing_backlog,
    "q_top_resolvers": top_resolvers,
    "q_oldest_bugs": oldest_bugs,
    "q_avg_in_review": average_in_status,
    "q_quarter_points": quarter_points,
    "q_worst_ratio": worst_ratio,
    "q_hours_90d": hours_90d,
    "q_age_distribution": age_distribution,
    "q_backlog_12w": backlog_12w,
    "q_overloaded": overloaded,
}
