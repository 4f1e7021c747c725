"""Registered queries: (spark, folder of sample parquet files) -> DataFrame."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.config import LayerConfig
from flowlens.operators import bridges, facts
from flowlens.operators.entities import attach_by_id_or_name
from flowlens.operators.expectations import union_all
from flowlens.plans import gadgets
from flowlens.plans.datasets import DATASETS, issue_medians_merged
from flowlens.plans.pipeline import GOLD, SILVER, STEPS, Pipeline
from flowlens.plans.questions import QUESTIONS, median_cycle_monthly
from flowlens.semantic.layer import MetricLayer
from flowlens.session import configure, folder_bytes, remove_folder, shared_folder
from flowlens.sources.columns import Target, project
from flowlens.sources.sample import LANDED, SAMPLE_AS_OF, SampleSource
from flowlens.sources.sinks import FolderStore

Query = Callable[[SparkSession, str], DataFrame]
LayerQuery = Callable[[MetricLayer], DataFrame]

# Raw tables are larger than the sample they are derived from: a line item alone is four
# changes, a worklog, a link and a member of sprints, components and versions.
DERIVED = 8

# The facts are written in one slice for each so many bytes of the sample, and in so many at most, as
# each of them reads the facts' inputs anew: the shuffles of a slice are on disk, not those of the whole.
SLICE_BYTES, MOST_SLICES = 64 * 1024**2, 4

_workspaces: dict[tuple[str, str], MetricLayer] = {}


def _discard(spark: SparkSession, root: str) -> None:
    """Delete the tables of an application that ends; one that has stopped cannot."""
    if spark.sparkContext._jsc is not None:
        remove_folder(spark, root)


def workspace(spark: SparkSession, folder: str) -> MetricLayer:
    """The layers over one sample folder, shared by the queries of an application.

    Tables that others read are written once to the shared folder, as a nightly
    build would, and every later query reads them from there.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _workspaces:
        size = folder_bytes(spark, folder)
        configure(spark, DERIVED * size)
        root = f"{shared_folder(spark)}/flowlens-{uuid.uuid4().hex}"
        atexit.register(_discard, spark, root)
        source = SampleSource(spark, folder)
        pipeline = Pipeline(
            source,
            LayerConfig(as_of=SAMPLE_AS_OF),
            FolderStore(spark, root, min(MOST_SLICES, 1 + size // SLICE_BYTES)),
            landed=LANDED,
        )
        source.issues = lambda: pipeline.bronze("issues")
        _workspaces[key] = MetricLayer(pipeline)
    return _workspaces[key]


def comparable(frame: DataFrame) -> DataFrame:
    """Types every engine prints alike: numbers to six digits, dates and lists as text."""

    def shown(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = F.round(column, 6).cast("double")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.when(column.isNotNull(), F.concat_ws(",", column))
        return column.alias(field.name)

    return frame.select(*[shown(field) for field in frame.schema])


def _over(build: LayerQuery) -> Query:
    return lambda spark, folder: comparable(build(workspace(spark, folder)))


def _silver_table(name: str) -> LayerQuery:
    return lambda layer: layer.pipeline.frame(f"silver.{name}")


def _gold_table(name: str) -> LayerQuery:
    return lambda layer: layer.pipeline.frame(f"gold.{name}")


def _step(name: str) -> LayerQuery:
    return lambda layer: layer.pipeline.frame(f"step.{name}")


def _by_fields(view: str, *fields: str) -> LayerQuery:
    """All measures of a view at one grain."""

    def build(layer: MetricLayer) -> DataFrame:
        bound = layer.view(view)
        return bound.query(fields, [measure.name for measure in bound.view.measures])

    return build


def _from_summary(summary: str, *fields: str) -> LayerQuery:
    """All measures of a view at one grain, merged from its summary."""

    def build(layer: MetricLayer) -> DataFrame:
        bound = layer.summary(summary)
        return bound.query(fields, [measure.name for measure in bound.bound.view.measures])

    return build


def _all_rows(view: str) -> LayerQuery:
    """All fields of a view, row by row, through all of its joins."""

    def build(layer: MetricLayer) -> DataFrame:
        bound = layer.view(view)
        return bound.rows([field.name for field in bound.view.fields])

    return build


def _resolved_columns(layer: MetricLayer) -> DataFrame:
    """Three spellings of the issue source brought to one shape."""
    issues = layer.pipeline.bronze("issues")
    targets = [
        Target("id", "string", ("id",), required=True),
        Target("issue_key", "string", ("key", "issue_key")),
        Target("created_at", "timestamp", ("created", "created_at")),
        Target("resolved_at", "timestamp", ("resolutionDate", "resolutiondate", "resolved", "resolved_at")),
        Target("environment", "string", ("environment",)),
    ]
    legacy = issues.select(
        "id",
        F.col("key").alias("issue_key"),
        F.col("created").alias("created_at"),
        F.col("resolutionDate").alias("resolved_at"),
    )
    bare = issues.select("id", F.col("resolutionDate").alias("resolved"))
    spellings = {"camel": issues, "snake": legacy, "bare": bare}
    return union_all(
        [
            project(frame, targets).withColumn("spelling", F.lit(spelling))
            for spelling, frame in spellings.items()
        ]
    )


def _missing_sources(layer: MetricLayer) -> DataFrame:
    """Rows of the array bridges with their source column and without it."""
    issues = layer.pipeline.bronze("issues")
    types = layer.pipeline.bronze("issue_types")
    without = issues.drop("sprint_ids", "component_ids", "fix_version_ids", "parent_id")
    parts = []
    for variant, source in (("present", issues), ("missing", without)):
        built = {
            "sprint_issue": bridges.sprint_issue(source),
            "issue_component": bridges.issue_component(source),
            "issue_version": bridges.issue_version(source),
            "epic_issue": bridges.epic_issue(source, types, "epic"),
        }
        for name, frame in built.items():
            parts.append(
                frame.agg(
                    F.lit(name).alias("bridge"),
                    F.lit(variant).alias("variant"),
                    F.count(F.lit(1)).alias("rows"),
                )
            )
    return union_all(parts)


def _component_names(layer: MetricLayer) -> DataFrame:
    """Components of issues by name; five names, each used in several projects."""
    p = layer.pipeline
    name = lambda number: F.concat(F.lit("Component "), (number % 5).cast("string"))
    issues = p.bronze("issues").select("id", F.transform("component_ids", name).alias("components"))
    components = p.silver("component").withColumn("name", name(F.col("id")))
    return bridges.issue_component(issues, components, p.silver("issue"))


def _version_names(layer: MetricLayer) -> DataFrame:
    """Versions of issues, every other one by a name that all projects use."""
    p = layer.pipeline

    def named(version: Column) -> Column:
        by_name = F.concat(F.lit("Release "), (version % 10000).cast("string"))
        return F.when(version % 2 == 0, by_name).otherwise(version.cast("string"))

    issues = p.bronze("issues").select("id", F.transform("fix_version_ids", named).alias("fix_versions"))
    return bridges.issue_version(issues, p.silver("version"), p.silver("project_version"), p.silver("issue"))


def _priority_or_join(layer: MetricLayer) -> DataFrame:
    """Issues that name one priority by id and another by name get both."""
    p = layer.pipeline
    status_as_priority = (
        F.when(F.col("status") == "Done", "Critical")
        .when(F.col("status") == "To Do", "Low")
        .otherwise("No such priority")
    )
    rows = p.bronze("issues").select("id", "priorityId", status_as_priority.alias("priority"))
    lookup = p.bronze("priority").select("id", "name")
    return attach_by_id_or_name(rows, lookup, "priorityId", "priority", "priority_id").select(
        "id", "priorityId", "priority", "priority_id"
    )


def _dropped_links(layer: MetricLayer) -> DataFrame:
    """Links before and after the endpoint check, per link type."""
    p = layer.pipeline
    before = p.frame("silver.issue_link", checked=False).groupBy("link_type_id").agg(F.count("*").alias("landed"))
    after = p.frame("silver.issue_link").groupBy("link_type_id").agg(F.count("*").alias("kept"))
    return before.join(after, "link_type_id", "left").select(
        "link_type_id", "landed", F.coalesce("kept", F.lit(0)).alias("kept")
    )


def _issue_times(layer: MetricLayer) -> DataFrame:
    p = layer.pipeline
    started = p.table("step.first_in_progress").select(
        F.col("issue_id").alias("id"), F.col("started_at").alias("first_in_progress_at")
    )
    issues = p.silver("issue").select("id", "created_at", "resolved_at").join(started, "id", "left")
    return facts.issue_times(issues, p.config).select(
        F.col("id").alias("issue_id"), "is_resolved", "cycle_time_days", "lead_time_days", "age_days"
    )


def _age_histogram(layer: MetricLayer) -> DataFrame:
    rows = layer.pipeline.gold("fct_issue").where(~F.col("is_resolved"))
    return rows.groupBy("age_bucket").agg(F.count("*").alias("open_issues"))


def _grain_check(layer: MetricLayer) -> DataFrame:
    """How many issue ids occur more than once, and the rows they take up."""
    rows = layer.pipeline.gold("fct_issue")
    return facts.grain_check(rows).agg(
        F.count("*").alias("repeated_ids"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")
    )


def _join_pruning(layer: MetricLayer) -> DataFrame:
    """A count by a source field needs none of the view's five joins."""
    return layer.view("issue").query({"status": "Status"}, {"issues": "Issue Count"})


def _synonyms(layer: MetricLayer) -> DataFrame:
    """Everything named by a synonym, through two joins."""
    return layer.view("issue").query(
        {"lead": "project owner", "owner": "engineer"},
        {"backlog": "backlog", "wip": "work in progress", "throughput": "throughput"},
    )


def _filtered_portfolio(layer: MetricLayer) -> DataFrame:
    """Portfolio counters for two chosen projects."""
    return gadgets.counters(
        layer, "portfolio", {"project_key": ["NATION_3", "NATION_7"], "assignee_name": []}
    )


def _selector_values(layer: MetricLayer) -> DataFrame:
    return gadgets.selector_values(layer, "portfolio", "project_key")


# View and fields to group its measures by.  Percentiles are sketches that are
# exact up to some ten thousand values, so transitions are split by project too.
GRAINS = {
    "metric_issue_by_project": ("issue", "Project Key"),
    "metric_sprint_velocity_by_project": ("sprint_velocity", "Project Key"),
    "metric_transitions_by_status": ("issue_transitions", "Project Name", "To Status"),
    "metric_worklog_by_author": ("worklog", "Author"),
    "metric_project_health_all": ("project_health", "Project Category"),
    "metric_assignee_load_by_bucket": ("assignee_load", "Age Bucket"),
    "metric_team_productivity_all": ("team_productivity", "Assignee Email"),
    "metric_time_in_status_all": ("time_in_status", "Status Category"),
    "metric_flow_monthly": ("flow", "Flow Month"),
}

# The same grains from stored summaries, whose sketches are exact for so few values.
SUMMARISED = {
    "summary_issue_by_project": ("issue", "Project Key"),
    "summary_transitions_by_status": ("issue_transitions", "Project Name", "To Status"),
}

VIEWS = (
    "issue sprint_velocity issue_transitions worklog project_health assignee_load "
    "team_productivity time_in_status flow"
).split()


def _build() -> dict[str, Query]:
    found: dict[str, LayerQuery] = {
        "bronze_resolve_columns": _resolved_columns,
        "bridge_missing_source_empty": _missing_sources,
        "bridge_component_names": _component_names,
        "bridge_version_names": _version_names,
        "build_all_row_counts": lambda layer: layer.pipeline.row_counts(),
        "expect_fail_metrics": lambda layer: layer.pipeline.audit("fail"),
        "expect_drop_issue_link": _dropped_links,
        "expectation_audit": lambda layer: layer.pipeline.audit(),
        "silver_issue_priority_or_join": _priority_or_join,
        "fct_issue_times": _issue_times,
        "age_bucket_histogram": _age_histogram,
        "fct_issue_grain_check": _grain_check,
        "created_resolved_daily": lambda layer: layer.table("created_resolved_daily"),
        "metric_global_wip": lambda layer: layer.view("issue").query((), {"wip": "WIP Issues"}),
        "metric_join_pruning": _join_pruning,
        "metric_synonym_backlog": _synonyms,
        "filtered_portfolio": _filtered_portfolio,
        "selector_values": _selector_values,
        "check_open_total": gadgets.check_open_total,
        "check_open_by_priority": gadgets.check_open_by_priority,
    }
    found |= {f"silver_{name}": _silver_table(name) for name in SILVER}
    found |= {name: _step(name) for name in STEPS}
    found |= {name: _gold_table(name) for name in GOLD}
    found |= {name: _by_fields(*grain) for name, grain in GRAINS.items()}
    found |= {f"metric_{view}_rows": _all_rows(view) for view in VIEWS}
    found |= {name: _from_summary(*grain) for name, grain in SUMMARISED.items()}
    found["summary_issue_medians"] = issue_medians_merged
    found["selector_reach"] = lambda layer: gadgets.selector_reach(layer, "flow", "project_key")
    found |= DATASETS
    found |= {
        f"kpi_{section}": lambda layer, section=section: gadgets.counters(layer, section)
        for section in gadgets.COUNTERS
    }
    found |= {
        name: lambda layer, name=name: gadgets.chart(layer, name) for name in gadgets.CHARTS
    }
    found |= {
        name: lambda layer, name=name: gadgets.listing(layer, name) for name in gadgets.LISTINGS
    }
    found |= QUESTIONS
    found["q_median_cycle_monthly"] = lambda layer: median_cycle_monthly(layer, "NATION_3")
    return {name: _over(build) for name, build in found.items()}


QUERIES = _build()
