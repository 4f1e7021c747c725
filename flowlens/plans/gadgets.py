"""Report gadgets: counters, charts and tables rolled up from the datasets."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.operators.expectations import union_all
from flowlens.plans.datasets import DATASETS, FOLDS, SLICES, Slice
from flowlens.semantic.layer import MetricLayer

# The aggregates a gadget may use.
AGGREGATES = {"SUM": F.sum, "AVG": F.avg, "COUNT": F.count, "MAX": F.max, "MIN": F.min}

Filters = Mapping[str, Sequence[object]]


def aggregate(function: str, column: str) -> Column:
    """An allowed aggregate of a dataset column; ``COUNT`` of ``*`` counts rows."""
    if function.upper() not in AGGREGATES:
        raise ValueError(f"{function} is not one of {', '.join(AGGREGATES)}")
    operand = F.lit(1) if column == "*" else F.col(column)
    return AGGREGATES[function.upper()](operand)


def filtered(dataset: DataFrame, filters: Filters | None = None) -> DataFrame:
    """Keep rows whose value is selected; no selection, or no such column, keeps all."""
    for column, selected in (filters or {}).items():
        if selected and column in dataset.columns:
            dataset = dataset.where(F.col(column).isin(*selected))
    return dataset


def rollup(
    dataset: DataFrame,
    dims: Sequence[str],
    totals: Mapping[str, tuple[str, str]],
    filters: Filters | None = None,
) -> DataFrame:
    """Group a dataset by ``dims``; ``totals`` maps labels to (function, column)."""
    columns = [aggregate(*total).alias(label) for label, total in totals.items()]
    return filtered(dataset, filters).groupBy(*dims).agg(*columns)


@dataclass(frozen=True)
class Counter:
    title: str
    dataset: str
    function: str
    column: str


# The counters of each report section.
COUNTERS: dict[str, tuple[Counter, ...]] = {
    "portfolio": (
        Counter("Open issues", "ds_issue_kpi", "SUM", "open_issues"),
        Counter("Created (30d)", "ds_issue_kpi", "SUM", "created_30d"),
        Counter("Resolved (30d)", "ds_issue_kpi", "SUM", "resolved_30d"),
        Counter("Net backlog (30d)", "ds_issue_kpi", "SUM", "net_backlog_30d"),
        Counter("Open critical", "ds_issue_kpi", "SUM", "open_critical"),
        Counter("Flow ratio (30d)", "ds_project_health", "AVG", "flow_ratio_30d"),
    ),
    "flow": (
        Counter("Median cycle (days)", "ds_issue_medians", "AVG", "median_cycle"),
        Counter("Median lead (days)", "ds_issue_medians", "AVG", "median_lead"),
        Counter("Open >30d", "ds_issue_open", "SUM", "is_stale_open"),
        Counter("Stale critical", "ds_issue_open", "SUM", "is_stale_critical"),
        Counter("WIP", "ds_issue_kpi", "SUM", "wip_issues"),
        Counter("Overdue open", "ds_issue_kpi", "SUM", "overdue_open"),
    ),
    "sprint": (
        Counter("Active sprints", "ds_velocity", "SUM", "is_active"),
        Counter("Avg completion (last 12)", "ds_velocity_recent", "AVG", "completion_ratio"),
        Counter("Points completed (30d)", "ds_velocity", "SUM", "points_completed_30d"),
        Counter("Carryover points (last 12)", "ds_velocity_recent", "SUM", "carryover_points"),
    ),
    "team": (
        Counter("Active contributors", "ds_team_prod", "SUM", "is_active_contributor"),
        Counter("Avg open load", "ds_team_prod", "AVG", "open_now"),
        Counter("Unassigned open", "ds_issue_kpi", "SUM", "unassigned_open"),
        Counter("Team avg cycle (d)", "ds_team_prod", "AVG", "avg_cycle_time_days"),
        Counter("Hours logged (30d)", "ds_worklog", "SUM", "hours_30d"),
    ),
}

# Selectors of each section and the datasets they apply to.
SELECTORS: dict[str, dict[str, tuple[str, ...]]] = {
    "portfolio": {
        "project_key": (
            "ds_issue",
            "ds_issue_open",
            "ds_issue_kpi",
            "ds_project_health",
            "ds_flow_series",
            "ds_flow_weekly",
        )
    },
    "flow": {
        "project_key": (
            "ds_issue_open",
            "ds_issue_resolved_180",
            "ds_issue_medians",
            "ds_time_in_status",
            "ds_issue_kpi",
        )
    },
    "sprint": {"project_key": ("ds_velocity", "ds_velocity_recent", "ds_velocity_series")},
    "team": {
        "assignee_name": ("ds_team_prod", "ds_assignee_load"),
        "project_key": ("ds_assignee_load", "ds_worklog", "ds_issue_kpi"),
    },
}


def selected(section: str, dataset: str, choices: Filters | None) -> dict[str, Sequence[object]]:
    """The choices of a section's selectors that apply to one dataset."""
    reach = SELECTORS[section]
    return {
        column: values
        for column, values in (choices or {}).items()
        if dataset in reach.get(column, ())
    }


def _folded(layer: MetricLayer, members: list[Counter], choices: Filters) -> DataFrame:
    """One row of counters over datasets that are folds of one view, from one scan of it."""
    measures, adhoc, derived = {}, {}, {}
    for counter in members:
        fold, label = FOLDS[counter.dataset], f"{counter.dataset}__{counter.column}"
        if counter.column in fold.measures:
            measures[label] = fold.measures[counter.column]
        elif counter.column in fold.derived:
            derived[label] = fold.derived[counter.column]
        else:
            adhoc[label] = fold.totals[counter.column](layer)
    totals = layer.view(FOLDS[members[0].dataset].view).query(
        {"project_key": "Project Key"}, measures, adhoc=adhoc, derived=derived
    )
    return filtered(totals, choices).agg(
        *[
            aggregate(counter.function, f"{counter.dataset}__{counter.column}").alias(f"value_{position}")
            for position, counter in enumerate(members)
        ]
    )


def _foldable(counter: Counter) -> bool:
    fold = FOLDS.get(counter.dataset)
    if fold is None or counter.function not in fold.allowed:
        return False
    return any(counter.column in columns for columns in (fold.measures, fold.totals, fold.derived))


def counters(layer: MetricLayer, section: str, choices: Filters | None = None) -> DataFrame:
    """The counters of a section as (section, counter, value) rows.

    Counters over datasets that are folds of one view come from one aggregation by project,
    as far as the same choices reach them; others over one dataset from one aggregation
    of it.
    """
    groups: dict[tuple, list[Counter]] = {}
    for counter in COUNTERS[section]:
        chosen = selected(section, counter.dataset, choices)
        if _foldable(counter) and set(chosen) <= {"project_key"}:
            key = ("fold", FOLDS[counter.dataset].view, *map(tuple, chosen.values()))
        else:
            key = ("dataset", counter.dataset)
        groups.setdefault(key, []).append(counter)
    parts = []
    for (kind, *_), members in groups.items():
        chosen = selected(section, members[0].dataset, choices)
        lines = [
            F.struct(
                F.lit(section).alias("section"),
                F.lit(counter.title).alias("counter"),
                F.col(f"value_{position}").cast("double").alias("value"),
            )
            for position, counter in enumerate(members)
        ]
        if kind == "fold":
            totals = _folded(layer, members, chosen)
        else:
            totals = filtered(DATASETS[members[0].dataset](layer), chosen).agg(
                *[
                    aggregate(counter.function, counter.column).alias(f"value_{position}")
                    for position, counter in enumerate(members)
                ]
            )
        parts.append(totals.select(F.explode(F.array(*lines)).alias("line")).select("line.*"))
    return union_all(parts)


@dataclass(frozen=True)
class Chart:
    """A grouped gadget: dimensions, labelled aggregates and an optional order."""

    section: str
    dataset: str
    dims: tuple[str, ...]
    totals: tuple[tuple[str, str, str], ...]
    order: str | None = None


# Grouped charts of the report.
CHARTS: dict[str, Chart] = {
    "bar_flow_weekly": Chart(
        "portfolio", "ds_flow_series", ("flow_week", "series"), (("issues", "SUM", "issues"),)
    ),
    "bar_open_by_project": Chart(
        "portfolio", "ds_issue_open", ("project_key",), (("count", "COUNT", "*"),), "-count"
    ),
    "hist_cycle_time": Chart(
        "flow", "ds_issue_resolved_180", ("cycle_bucket",), (("count", "COUNT", "*"),)
    ),
    "bar_open_by_age": Chart("flow", "ds_issue_open", ("age_bucket",), (("count", "COUNT", "*"),)),
    "bar_velocity": Chart(
        "sprint", "ds_velocity_series", ("sprint_name", "series"), (("points", "SUM", "points"),)
    ),
    "line_completion_ratio": Chart(
        "sprint", "ds_velocity_recent", ("sprint_name",), (("ratio", "AVG", "completion_ratio"),)
    ),
    "bar_load": Chart(
        "team",
        "ds_assignee_load",
        ("assignee_name", "priority"),
        (("open_issues", "SUM", "open_issues"),),
        "-open_issues",
    ),
}


def chart(layer: MetricLayer, name: str, choices: Filters | None = None) -> DataFrame:
    spec = CHARTS[name]
    frame = rollup(
        DATASETS[spec.dataset](layer),
        spec.dims,
        {label: (function, column) for label, function, column in spec.totals},
        selected(spec.section, spec.dataset, choices),
    )
    if spec.order:
        frame = frame.orderBy(F.col(spec.order.removeprefix("-")).desc(), *spec.dims)
    return frame


# Row gadgets, as dataset and output label to dataset column.
LISTINGS: dict[str, tuple[str, str, dict[str, str]]] = {
    "scatter_team": (
        "team",
        "ds_team_prod",
        {
            "cycle": "avg_cycle_time_days",
            "resolved": "resolved_90d",
            "assignee": "assignee_name",
        },
    ),
    "table_project_scorecard": (
        "portfolio",
        "ds_project_health",
        {
            "project_key": "project_key",
            "project_name": "project_name",
            "open_issues": "open_issues",
            "open_critical": "open_critical",
            "stale_open": "stale_open",
            "created_last_30d": "created_last_30d",
            "resolved_last_30d": "resolved_last_30d",
            "net_backlog_30d": "net_backlog_30d",
            "flow_ratio_30d": "flow_ratio_30d",
            "avg_cycle_time_days": "avg_cycle_time_days",
        },
    ),
    "table_time_in_status": (
        "flow",
        "ds_time_in_status",
        {
            "project_key": "project_key",
            "status_name": "status_name",
            "p50_hours": "p50_hours",
            "p90_hours": "p90_hours",
            "observations": "observations",
        },
    ),
    "table_sprint_outcomes": (
        "sprint",
        "ds_velocity",
        {
            "sprint_name": "sprint_name",
            "state": "state",
            "start_date": "start_date",
            "complete_date": "complete_date",
            "points_in_sprint": "points_in_sprint",
            "points_completed": "points_completed",
            "completion_ratio": "completion_ratio",
            "issues_in_sprint": "issues_in_sprint",
            "issues_completed": "issues_completed",
        },
    ),
    "table_assignee_scorecard": (
        "team",
        "ds_team_prod",
        {
            "assignee_name": "assignee_name",
            "resolved_30d": "resolved_30d",
            "resolved_90d": "resolved_90d",
            "open_now": "open_now",
            "open_critical": "open_critical",
            "avg_cycle_time_days": "avg_cycle_time_days",
            "avg_lead_time_days": "avg_lead_time_days",
        },
    ),
}


def listing(layer: MetricLayer, name: str, choices: Filters | None = None) -> DataFrame:
    section, dataset, columns = LISTINGS[name]
    frame = filtered(DATASETS[dataset](layer), selected(section, dataset, choices))
    return frame.select(*[F.col(column).alias(label) for label, column in columns.items()])


def selector_reach(layer: MetricLayer, section: str, column: str) -> DataFrame:
    """(column, dataset) of each value that a selector offers and the datasets that have it.

    Datasets that are conditions on one view are a flag each over one scan of its table;
    only datasets that are no condition, such as the last sprints, are read on their own.
    """
    by_view: dict[str, dict[str, Slice]] = {}
    parts = []
    for dataset in SELECTORS[section][column]:
        if dataset in SLICES and column in SLICES[dataset].columns:
            by_view.setdefault(SLICES[dataset].view, {})[dataset] = SLICES[dataset]
        else:
            values = DATASETS[dataset](layer).select(column).distinct()
            parts.append(values.withColumn("dataset", F.lit(dataset)))
    for view, slices in by_view.items():
        fields = {one.columns[column] for one in slices.values()}
        if len(fields) > 1:
            raise ValueError(f"{column} is several fields of {view}: {', '.join(sorted(fields))}")
        conditions = {dataset: one.where(layer) if one.where else None for dataset, one in slices.items()}

        def flag(dataset: str, conditions: Mapping = conditions) -> Callable:
            condition = conditions[dataset]
            return lambda f: F.max(F.coalesce(condition(f), F.lit(False)) if condition else F.lit(True))

        def any_of(f: Callable[[str], Column], conditions: Mapping = conditions) -> Column:
            return reduce(Column.__or__, [condition(f) for condition in conditions.values()])

        flagged = layer.view(view).query(
            {column: fields.pop()},
            adhoc={dataset: flag(dataset) for dataset in slices},
            where=None if None in conditions.values() else any_of,
        )
        named = F.array_compact(F.array(*[F.when(F.col(dataset), F.lit(dataset)) for dataset in slices]))
        parts.append(flagged.select(column, F.explode(named).alias("dataset")))
    return union_all(parts)


def selector_values(layer: MetricLayer, section: str, column: str) -> DataFrame:
    """Values a selector offers: the distinct ones of all datasets it applies to."""
    return selector_reach(layer, section, column).select(column).distinct()


def check_open_total(layer: MetricLayer) -> DataFrame:
    """Open issues, once straight from the measure and once through the dataset."""
    direct = layer.view("project_health").query((), {"value": "Open Issues"})
    through = DATASETS["ds_project_health"](layer).agg(F.sum("open_issues").alias("value"))
    return direct.select(F.lit("measure").alias("path"), "value").unionByName(
        through.select(F.lit("dataset").alias("path"), "value")
    )


def check_open_by_priority(layer: MetricLayer) -> DataFrame:
    """Open issues per project and priority."""
    return rollup(
        DATASETS["ds_issue_open"](layer), ["project_key", "priority"], {"count": ("COUNT", "*")}
    )
