"""Silver tables that only map, cast and check the columns of one source table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators.expectations import Expectation, drop, fail
from flowlens.sources.columns import Target, project


@dataclass(frozen=True)
class Projection:
    source: str
    targets: tuple[Target, ...]
    distinct: bool = False
    present: str | None = None

    def build(self, raw: DataFrame) -> DataFrame:
        frame = project(raw, self.targets)
        if self.present:
            frame = frame.where(F.col(self.present).isNotNull())
        return frame.distinct() if self.distinct else frame


# Target columns, their types and the source spellings tried in order.
PROJECTIONS: dict[str, Projection] = {
    "issue_comment": Projection(
        "issue_comments",
        (
            Target("id", "string", ("id",), required=True),
            Target("issue_id", "string", ("issue_id", "issueId")),
            Target("author_id", "string", ("author_account_id", "author")),
            Target("update_author_id", "string", ("update_author_account_id", "update_author")),
            Target("body", "string", ("body",)),
            Target("created_at", "timestamp", ("created", "created_at")),
            Target("updated_at", "timestamp", ("updated", "updated_at")),
        ),
    ),
    "issue_type": Projection(
        "issue_types",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("name", "string", ("name",), required=True),
            Target("description", "string", ("description",)),
            Target("icon_url", "string", ("icon_url",)),
            Target("is_subtask", "boolean", ("subtask", "is_subtask")),
        ),
    ),
    "project": Projection(
        "projects",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("project_key", "string", ("key", "project_key")),
            Target("name", "string", ("name",)),
            Target("description", "string", ("description",)),
            Target("project_category_id", "bigint", ("project_category_id", "projectCategory")),
            Target("project_type_key", "string", ("project_type_key", "projectTypeKey")),
            Target("lead_id", "string", ("lead_account_id", "lead")),
            Target("url", "string", ("url",)),
            Target("style", "string", ("style",)),
            Target("is_archived", "boolean", ("archived", "is_archived")),
        ),
    ),
    "project_category": Projection(
        "project_categories",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("name", "string", ("name",), required=True),
            Target("description", "string", ("description",)),
        ),
    ),
    "project_role": Projection(
        "project_roles",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("name", "string", ("name",), required=True),
            Target("description", "string", ("description",)),
        ),
    ),
    "project_role_actor": Projection(
        "project_role_actor",
        (
            Target("project_id", "bigint", ("project_id", "projectId")),
            Target("role_id", "bigint", ("role_id", "roleId")),
            Target("actor_id", "string", ("actor_id", "actorId")),
            Target("actor_type", "string", ("actor_type", "actorType")),
            Target("actor_name", "string", ("actor_name", "actorName")),
        ),
    ),
    "user": Projection(
        "users",
        (
            Target("account_id", "string", ("account_id", "id")),
            Target("display_name", "string", ("display_name", "displayName")),
            Target("email", "string", ("email_address", "email", "emailId")),
            Target("is_active", "boolean", ("active", "is_active")),
            Target("account_type", "string", ("account_type", "accountType")),
            Target("locale", "string", ("locale",)),
            Target("time_zone", "string", ("time_zone", "timeZone")),
        ),
    ),
    "priority": Projection(
        "priority",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("name", "string", ("name",)),
            Target("description", "string", ("description",)),
            Target("color", "string", ("status_color", "color")),
            Target("icon_url", "string", ("icon_url",)),
        ),
    ),
    "resolution": Projection(
        "resolutions",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("name", "string", ("name",), required=True),
            Target("description", "string", ("description",)),
        ),
    ),
    "field": Projection(
        "issue_fields",
        (
            Target("id", "string", ("id",), required=True),
            Target("name", "string", ("name",)),
            Target("description", "string", ("description",)),
            Target("is_custom", "boolean", ("custom", "is_custom")),
            Target("schema_type", "string", ("schema_type", "type")),
            Target("schema_items", "string", ("schema_items",)),
        ),
    ),
    "issue_worklog": Projection(
        "issue_worklogs",
        (
            Target("id", "string", ("id",), required=True),
            Target("issue_id", "string", ("issue_id", "issueId")),
            Target("author_id", "string", ("author_account_id", "author_id", "author")),
            Target("time_spent_seconds", "bigint", ("time_spent_seconds",)),
            Target("started_at", "timestamp", ("started", "started_at")),
            Target("created_at", "timestamp", ("created", "created_at")),
            Target("updated_at", "timestamp", ("updated", "updated_at")),
            Target("comment", "string", ("comment",)),
        ),
    ),
    "issue_watcher": Projection(
        "issue_watchers",
        (
            Target("issue_id", "string", ("issue_id", "issueId")),
            Target("watcher_id", "string", ("watcher_account_id", "userId", "watcher_id")),
        ),
    ),
    "component": Projection(
        "project_components",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("name", "string", ("name",)),
            Target("description", "string", ("description",)),
            Target("lead_id", "string", ("lead_account_id", "lead")),
            Target("project_id", "bigint", ("project_id", "projectId")),
            Target("assignee_type", "string", ("assignee_type", "assigneeType")),
        ),
    ),
    "version": Projection(
        "version",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("name", "string", ("name",)),
            Target("description", "string", ("description",)),
            Target("is_archived", "boolean", ("archived",)),
            Target("is_released", "boolean", ("released",)),
            Target("release_date", "date", ("release_date",)),
            Target("start_date", "date", ("start_date",)),
        ),
    ),
    "board": Projection(
        "boards",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("name", "string", ("name",)),
            Target("board_type", "string", ("type", "board_type")),
            Target("project_id", "bigint", ("project_id", "projectId")),
            Target("filter_id", "bigint", ("filter_id", "filterId")),
            Target("location_type", "string", ("location_type", "location")),
        ),
    ),
    "project_board": Projection(
        "project_board",
        (
            Target("project_id", "bigint", ("project_id", "projectId")),
            Target("board_id", "bigint", ("board_id", "boardId")),
        ),
    ),
    "sprint": Projection(
        "sprints",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("board_id", "bigint", ("board_id", "boardId")),
            Target("name", "string", ("name",)),
            Target("state", "string", ("state",)),
            Target("start_date", "timestamp", ("start_date", "startDate")),
            Target("end_date", "timestamp", ("end_date", "endDate")),
            Target("complete_date", "timestamp", ("complete_date", "completeDate")),
            Target("goal", "string", ("goal",)),
        ),
    ),
    "user_group": Projection(
        "user_group",
        (
            Target("account_id", "string", ("account_id",)),
            Target("group_id", "string", ("group_id",)),
            Target("group_name", "string", ("group_name",)),
        ),
    ),
    "application_role": Projection(
        "application_roles",
        (
            Target("application_role_key", "string", ("key",), required=True),
            Target("name", "string", ("name",)),
            Target("description", "string", ("description",)),
            Target("user_count", "int", ("user_count",)),
            Target("group_count", "int", ("group_count",)),
        ),
    ),
    "permission_scheme": Projection(
        "permission_schemes",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("name", "string", ("name",), required=True),
            Target("description", "string", ("description",), required=True),
        ),
    ),
    "security_scheme": Projection(
        "security_schemes",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("name", "string", ("name",), required=True),
            Target("description", "string", ("description",), required=True),
            Target("default_security_level_id", "bigint", ("default_security_level_id",)),
        ),
    ),
    "security_level": Projection(
        "security_level",
        (
            Target("id", "bigint", ("id",), required=True),
            Target("name", "string", ("name",), required=True),
            Target("description", "string", ("description",), required=True),
            Target("security_scheme_id", "bigint", ("security_scheme_id",)),
        ),
    ),
    "project_permission": Projection(
        "project_permissions",
        (
            Target("project_id", "bigint", ("project_id",)),
            Target("permission", "string", ("permission",)),
            Target("holder_type", "string", ("holder_type",)),
            Target("holder_value", "string", ("holder_value",)),
        ),
    ),
    # Lookups derived from a bridge-like source by removing repeats.
    "group": Projection(
        "user_group",
        (
            Target("id", "string", ("group_id",)),
            Target("name", "string", ("group_name",)),
        ),
        distinct=True,
        present="id",
    ),
    "project_version": Projection(
        "version",
        (
            Target("project_id", "bigint", ("project_id",)),
            Target("version_id", "bigint", ("id",), required=True),
        ),
        distinct=True,
    ),
    "issue_link_type": Projection(
        "issue_links",
        (
            Target("id", "bigint", ("link_type_id",)),
            Target("name", "string", ("link_type_name", "relationship")),
            Target("inward_description", "string", ("inward", "inward_description")),
            Target("outward_description", "string", ("outward", "outward_description")),
        ),
        distinct=True,
        present="name",
    ),
}

_ID_PRESENT = drop("valid_id", "id IS NOT NULL")

# The checks each silver table is held to.
EXPECTATIONS: dict[str, tuple[Expectation, ...]] = {
    "issue": (fail("issue_id_not_null", "id IS NOT NULL"),),
    "project": (fail("project_id_not_null", "id IS NOT NULL"),),
    "user": (fail("account_id_not_null", "account_id IS NOT NULL"),),
    "issue_comment": (_ID_PRESENT,),
    "issue_type": (_ID_PRESENT,),
    "project_category": (_ID_PRESENT,),
    "status": (_ID_PRESENT,),
    "priority": (_ID_PRESENT,),
    "resolution": (_ID_PRESENT,),
    "component": (_ID_PRESENT,),
    "version": (_ID_PRESENT,),
    "board": (_ID_PRESENT,),
    "sprint": (_ID_PRESENT,),
    "permission_scheme": (_ID_PRESENT,),
    "security_scheme": (_ID_PRESENT,),
    "security_level": (_ID_PRESENT,),
    "issue_field_history": (
        drop("not_null_issue", "issue_id IS NOT NULL"),
        drop("not_null_field", "field_id IS NOT NULL"),
    ),
    "issue_multiselect_history": (
        drop("not_null_issue", "issue_id IS NOT NULL"),
        drop("not_null_field", "field_id IS NOT NULL"),
    ),
    "issue_link": (
        drop(
            "valid_endpoints",
            "source_issue_id IS NOT NULL AND target_issue_id IS NOT NULL",
        ),
    ),
    "sprint_issue": (drop("valid_keys", "sprint_id IS NOT NULL AND issue_id IS NOT NULL"),),
    "epic_issue": (drop("valid_keys", "epic_id IS NOT NULL AND issue_id IS NOT NULL"),),
}
