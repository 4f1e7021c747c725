"""Gold dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.config import LayerConfig
from flowlens.functions.times import elapsed_days

# Display order of the status categories.
CATEGORY_ORDER = {"new": 1, "indeterminate": 2, "done": 3}
UNKNOWN_CATEGORY_ORDER = 99


def dim_user(users: DataFrame, user_groups: DataFrame) -> DataFrame:
    """Users with their group names in one sorted, comma-separated text."""
    memberships = user_groups.select("account_id", "group_name")
    return (
        users.join(memberships, "account_id", "left")
        .groupBy(*users.columns)
        .agg(F.concat_ws(", ", F.array_sort(F.collect_list("group_name"))).alias("groups"))
    )


def dim_project(
    projects: DataFrame, categories: DataFrame, users: DataFrame, issues: DataFrame
) -> DataFrame:
    """Projects with category, lead and issue counts.

    Issues are counted per project before anything is joined, so only one row
    per project meets the dimensions.  A project without issues counts as one
    open issue: the outer join leaves one row whose resolution time is null.
    """
    resolved = F.col("resolved_at").isNotNull()
    counts = issues.groupBy("project_id").agg(
        F.count("id").alias("total_issues"),
        F.count_if(~resolved).alias("open_issues"),
        F.count_if(resolved).alias("resolved_issues"),
    )
    named_categories = categories.select(
        F.col("id").alias("project_category_id"), F.col("name").alias("category_name")
    )
    leads = users.select(
        F.col("account_id").alias("lead_id"), F.col("display_name").alias("lead_name")
    )
    attributes = [
        "project_id",
        "project_key",
        "project_name",
        "description",
        "project_type_key",
        "category_name",
        "lead_id",
        "lead_name",
        "is_archived",
    ]
    return (
        projects.withColumnsRenamed({"id": "project_id", "name": "project_name"})
        .join(named_categories, "project_category_id", "left")
        .join(leads, "lead_id", "left")
        .join(counts, "project_id", "left")
        .groupBy(*attributes)
        .agg(
            F.sum(F.coalesce("total_issues", F.lit(0))).alias("total_issues"),
            F.sum(F.coalesce("open_issues", F.lit(1))).alias("open_issues"),
            F.sum(F.coalesce("resolved_issues", F.lit(0))).alias("resolved_issues"),
        )
    )


def category_order(key: Column) -> Column:
    order = F.lit(UNKNOWN_CATEGORY_ORDER)
    for name, position in CATEGORY_ORDER.items():
        order = F.when(key == name, position).otherwise(order)
    return order


def dim_status(statuses: DataFrame, categories: DataFrame) -> DataFrame:
    named = categories.select(
        F.col("id").alias("status_category_id"),
        "category_key",
        F.col("name").alias("category_name"),
        "color_name",
    )
    return statuses.join(named, "status_category_id", "left").select(
        F.col("id").alias("status_id"),
        F.col("name").alias("status_name"),
        "category_key",
        "category_name",
        "color_name",
        category_order(F.col("category_key")).alias("category_order"),
    )


def sprint_end() -> Column:
    """When a sprint ended or is due to."""
    return F.coalesce("complete_date", "end_date")


def dim_sprint(sprints: DataFrame, boards: DataFrame) -> DataFrame:
    named = boards.select(
        F.col("id").alias("board_id"), F.col("name").alias("board_name"), "project_id"
    )
    return sprints.join(named, "board_id", "left").select(
        F.col("id").alias("sprint_id"),
        F.col("name").alias("sprint_name"),
        "state",
        "start_date",
        "end_date",
        "complete_date",
        "goal",
        "board_id",
        "board_name",
        "project_id",
        elapsed_days(F.col("start_date"), sprint_end()).alias("duration_days"),
    )


def dim_date(issues: DataFrame, config: LayerConfig) -> DataFrame:
    """Calendar from two years before the first issue to one year after now."""
    day = F.col("date_key")
    first = F.date_sub(F.min(F.col("created_at").cast("date")), 730)
    span = issues.agg(first.alias("first"))
    days = span.select(
        F.explode(F.sequence("first", F.date_add(config.today(), 365))).alias("date_key")
    )
    return days.select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_name"),
        F.weekofyear(day).alias("iso_week"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )
