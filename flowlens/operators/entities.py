"""Silver entities that combine sources: issue, status and status category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.sources.columns import Target, project, resolve

# Issue columns taken over as they are, with their source spellings.
_ISSUE_COLUMNS = (
    Target("id", "string", ("id",), required=True),
    Target("issue_key", "string", ("key", "issue_key")),
    Target("summary", "string", ("summary",)),
    Target("description", "string", ("description",)),
    Target("reporter_id", "string", ("reporter", "reporter_account_id", "reporter_id")),
    Target("assignee_id", "string", ("assignee", "assignee_account_id", "assignee_id")),
    Target("creator_id", "string", ("creator", "creator_account_id", "creator_id")),
    Target("parent_id", "string", ("parent_id", "parentId", "parent")),
    Target("created_at", "timestamp", ("created", "created_at")),
    Target("updated_at", "timestamp", ("updated", "updated_at")),
    Target("resolved_at", "timestamp", ("resolutionDate", "resolutiondate", "resolved", "resolved_at")),
    Target("due_date", "date", ("due_date",)),
    Target("environment", "string", ("environment",)),
    Target("labels", "array<string>", ("labels",)),
    Target("story_points", "double", ("story_points",)),
    Target("original_estimate_seconds", "bigint", ("original_estimate_seconds",)),
    Target("remaining_estimate_seconds", "bigint", ("remaining_estimate_seconds",)),
    Target("time_spent_seconds", "bigint", ("time_spent_seconds",)),
    Target("watch_count", "int", ("watch_count",)),
    Target("vote_count", "int", ("vote_count",)),
)

# Names an issue gives for its lookups.
_ISSUE_KEYS = (
    Target("__project", "string", ("projectKey", "project_key")),
    Target("__status", "string", ("status",)),
    Target("__priority_id", "string", ("priorityId", "priority_id")),
    Target("__priority", "string", ("priority",)),
    Target("__type", "string", ("issueType", "issue_type")),
    Target("__resolution", "string", ("resolution",)),
)

# Order of the silver issue columns.
ISSUE_LAYOUT = (
    "id",
    "issue_key",
    "project_id",
    "issue_type_id",
    "summary",
    "description",
    "priority_id",
    "status_id",
    "resolution_id",
    "reporter_id",
    "assignee_id",
    "creator_id",
    "parent_id",
    "created_at",
    "updated_at",
    "resolved_at",
    "due_date",
    "environment",
    "labels",
    "story_points",
    "original_estimate_seconds",
    "remaining_estimate_seconds",
    "time_spent_seconds",
    "watch_count",
    "vote_count",
)

# Category keys for sources that only show the English name.
CATEGORY_KEYS = {"To Do": "new", "In Progress": "indeterminate", "Done": "done"}


def _named(lookup: DataFrame, key: str, output: str, *spellings: str) -> DataFrame:
    """Two columns of a lookup: the name issues refer to it by, and its id."""
    return project(
        lookup,
        [Target(key, "string", spellings), Target(output, "bigint", ("id",))],
    )


def attach_by_id_or_name(
    rows: DataFrame, lookup: DataFrame, row_id: str, row_name: str, output: str
) -> DataFrame:
    """Left join on ``id = row_id OR name = row_name`` as two equality joins.

    ``lookup`` has the columns ``id`` and ``name``.  Its entries are gathered
    once per id and once per name; a row then holds the union of both matches,
    one copy of the row per lookup entry.  Equality keys leave Spark free to
    broadcast or to shuffle, where the disjunction would force a nested loop.
    """
    entry = "struct<id:string,name:string,copy:bigint>"
    entries = (
        lookup.select(F.col("id").cast("string").alias("id"), "name")
        .groupBy("id", "name")
        .count()
        .select("id", "name", F.explode(F.sequence(F.lit(1).cast("bigint"), "count")).alias("copy"))
        .select("id", "name", F.struct("id", "name", "copy").alias("entry"))
    )

    def gathered(key: str, column: str, into: str) -> DataFrame:
        return (
            entries.where(F.col(key).isNotNull())
            .groupBy(F.col(key).alias(column))
            .agg(F.collect_list("entry").alias(into))
        )

    matches = F.coalesce(F.array_union("__by_id", "__by_name"), "__by_id", "__by_name")
    return (
        rows.join(gathered("id", row_id, "__by_id"), row_id, "left")
        .join(gathered("name", row_name, "__by_name"), row_name, "left")
        .withColumn("__match", F.explode_outer(matches.cast(f"array<{entry}>")))
        .withColumn(output, F.col("__match.id").cast("bigint"))
        .drop("__by_id", "__by_name", "__match")
    )


def issue(
    issues: DataFrame,
    projects: DataFrame,
    statuses: DataFrame,
    priorities: DataFrame,
    issue_types: DataFrame,
    resolutions: DataFrame,
) -> DataFrame:
    """Issues with their lookup names replaced by lookup ids.

    A name without a match gives a null id; a name that occurs twice in its
    lookup gives the issue twice.
    """
    rows = project(issues, _ISSUE_COLUMNS + _ISSUE_KEYS)
    lookups = (
        _named(projects, "__project", "project_id", "key", "project_key"),
        _named(statuses, "__status", "status_id", "name"),
        _named(issue_types, "__type", "issue_type_id", "name"),
        _named(resolutions, "__resolution", "resolution_id", "name"),
    )
    for lookup in lookups:
        rows = rows.join(lookup, lookup.columns[0], "left")
    known_priorities = project(
        priorities, [Target("id", "string", ("id",)), Target("name", "string", ("name",))]
    )
    rows = attach_by_id_or_name(
        rows, known_priorities, "__priority_id", "__priority", "priority_id"
    )
    return rows.select(*ISSUE_LAYOUT)


def status(statuses: DataFrame, categories: DataFrame) -> DataFrame:
    """Workflow states; the category is given by name, whatever its column is called."""
    rows = project(
        statuses,
        [
            Target("id", "bigint", ("id",), required=True),
            Target("name", "string", ("name",)),
            Target("description", "string", ("description",)),
            Target("__category", "string", ("status_category_id", "status_category")),
            Target("icon_url", "string", ("icon_url",)),
        ],
    )
    known = _named(categories, "__category", "status_category_id", "name")
    return rows.join(known, "__category", "left").select(
        "id", "name", "description", "status_category_id", "icon_url"
    )


def _category_key(source_key: Column, name: Column) -> Column:
    by_name = F.lower(name)
    for display, key in CATEGORY_KEYS.items():
        by_name = F.when(name == display, key).otherwise(by_name)
    return F.coalesce(source_key, by_name)


def status_category(categories: DataFrame) -> DataFrame:
    """Status categories with a language-independent key."""
    columns = categories.columns
    source_key = resolve(columns, Target("key", "string", ("key", "category_key")))
    name = resolve(columns, Target("name", "string", ("name",)))
    return categories.select(
        resolve(columns, Target("id", "bigint", ("id",), required=True)),
        _category_key(source_key, name).alias("category_key"),
        name,
        resolve(columns, Target("color_name", "string", ("color_name",))),
    )
