"""Silver bridges: links between issues, and issues to sprints, epics, components, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.sources.columns import Target, present_name, project, resolve


def issue_link(links: DataFrame) -> DataFrame:
    ends = project(
        links,
        [
            Target("source_issue_id", "string", ("source_issue_id", "issue_id")),
            Target("target_issue_id", "string", ("target_issue_id", "related_issue_id")),
            Target("link_type_id", "bigint", ("link_type_id",)),
            Target("kind", "string", ("relationship", "link_type_name")),
        ],
    )
    return ends.select(
        F.concat_ws("-", "source_issue_id", "target_issue_id", "kind").alias("id"),
        "source_issue_id",
        "target_issue_id",
        "link_type_id",
    )


def _element_id(element: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        element = element["id"]
    return element.try_cast("bigint")


def exploded_ids(
    issues: DataFrame,
    spellings: tuple[str, ...],
    output: str,
    names: DataFrame | None = None,
    homes: DataFrame | None = None,
) -> DataFrame:
    """Distinct (issue, id) pairs from an array column of the issues.

    Elements may be ids, ids in text, or structs with an ``id``.  Text that is
    no id is looked up in ``names`` (columns ``id``, ``name`` and ``project_id``)
    when given: a name counts within the issue's own project only, as projects
    name their parts alike.  ``homes`` (``id`` and ``project_id`` of the issues)
    tells the project; an issue without one matches no name.  Text formats such as
    CSV hold an array as JSON text, which is read as an array of text; other text has
    no elements.  Without any such column the bridge is empty, with the same schema.
    """
    issue_id = resolve(issues.columns, Target("issue_id", "string", ("id",), required=True))
    found = present_name(issues.columns, spellings)
    if found is None:
        return issues.select(issue_id, F.lit(None).cast("bigint").alias(output)).where(F.lit(False))
    array, kind = F.col(f"`{found}`"), issues.schema[found].dataType
    if isinstance(kind, T.StringType):
        array, kind = F.from_json(array, "array<string>"), T.ArrayType(T.StringType())
    kind = kind.elementType
    elements = issues.select(issue_id, F.explode(array).alias("element")).where(
        F.col("element").isNotNull()
    )
    element = F.col("element")
    pairs = elements.select("issue_id", _element_id(element, kind).alias(output), "element")
    if names is not None and homes is not None and isinstance(kind, T.StringType):
        places = homes.select(
            F.col("id").cast("string").alias("issue_id"), F.col("project_id").alias("__project")
        ).distinct()
        known = names.select(
            F.col("name").alias("element"),
            F.col("project_id").alias("__project"),
            F.col("id").alias("__named"),
        )
        named = pairs.where(F.col(output).isNull()).join(places, "issue_id")
        named = named.join(known, ["element", "__project"]).select(
            "issue_id", F.col("__named").alias(output)
        )
        pairs = pairs.select("issue_id", output).unionByName(named)
    return pairs.select("issue_id", output).where(F.col(output).isNotNull()).distinct()


def sprint_issue(issues: DataFrame) -> DataFrame:
    return exploded_ids(issues, ("sprint_ids", "sprints"), "sprint_id").select(
        "sprint_id", "issue_id"
    )


def issue_component(
    issues: DataFrame, components: DataFrame | None = None, homes: DataFrame | None = None
) -> DataFrame:
    return exploded_ids(issues, ("component_ids", "components"), "component_id", components, homes)


def issue_version(
    issues: DataFrame,
    versions: DataFrame | None = None,
    owners: DataFrame | None = None,
    homes: DataFrame | None = None,
) -> DataFrame:
    """``owners`` (``version_id`` and ``project_id``) tells the project of a version."""
    names = None
    if versions is not None and owners is not None:
        owned = owners.select(F.col("version_id").alias("id"), "project_id")
        names = versions.select("id", "name").join(owned, "id")
    return exploded_ids(issues, ("fix_version_ids", "fix_versions"), "version_id", names, homes)


def epic_issue(issues: DataFrame, issue_types: DataFrame, epic_name: str) -> DataFrame:
    """Distinct (epic, child) pairs: children whose parent is of the epic type.

    Both filters are semi joins over narrow columns.  Repeats are removed on the
    pair before the parent is looked up, so an epic with very many children is
    spread by child, and only the lookup itself meets the parent key.
    """
    columns = issues.columns
    if present_name(columns, ("parent_id", "parentId", "parent")) is None:
        nothing = F.lit(None).cast("string")
        return issues.select(nothing.alias("epic_id"), nothing.alias("issue_id")).where(F.lit(False))
    by_id = "issue_type_id" in columns
    epic_types = issue_types.where(F.lower("name") == epic_name.lower()).select(
        F.col("id" if by_id else "name").cast("string").alias("type")
    )
    epics = (
        project(
            issues,
            [
                Target("epic_id", "string", ("id",), required=True),
                Target("type", "string", ("issue_type_id", "issueType", "issue_type")),
            ],
        )
        .join(epic_types, "type", "left_semi")
        .select("epic_id")
    )
    children = project(
        issues,
        [
            Target("epic_id", "string", ("parent_id", "parentId", "parent")),
            Target("issue_id", "string", ("id",), required=True),
        ],
    )
    return children.distinct().join(epics, "epic_id", "left_semi")
