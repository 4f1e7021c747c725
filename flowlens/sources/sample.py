"""Raw tracker tables derived from the star-schema sample tables.

Each order plays an issue, each line item a piece of its history, customers and
suppliers are the users, nations the projects.  Lookups are read off the data
as well, so all tables grow with it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The moment the sample is looked at: one day after the last order.
SAMPLE_AS_OF = "2001-08-02 00:00:00"

# Raw tables to land before use: those costly to derive, and the lookups, so
# that the planner knows how small they are and broadcasts them.
LANDED = (
    "issues",
    "sprints",
    "version",
    "projects",
    "status",
    "status_category",
    "priority",
    "issue_types",
    "resolutions",
    "issue_fields",
    "boards",
)

FIRST_YEAR = 1995

# How sample codes spell in the tracker.
STATUS_OF_ORDER = {"O": "To Do", "P": "In Progress", "F": "Done"}
PRIORITY_NAMES = {"1": "Critical", "2": "High", "3": "Medium", "4": "Unspecified", "5": "Low"}
TYPE_NAMES = {0: "Epic", 1: "Bug", 2: "Story", 3: "Task", 4: "Sub-task"}
RESOLUTION_NAMES = {0: "Done", 1: "Won't Do", 2: "Duplicate"}
STATUS_NAMES = {1: "To Do", 2: "In Progress", 3: "In Review", 4: "Done"}
STATUS_CATEGORIES = {1: "To Do", 2: "In Progress", 3: "In Progress", 4: "Done"}
CATEGORY_IDS = {"O": 2, "P": 4, "F": 3}
CATEGORY_KEYS = {"O": "new", "P": "indeterminate"}
CATEGORY_COLORS = {"O": "blue-gray", "P": "yellow", "F": "green"}
FIELD_NAMES = {0: "status", 1: "assignee", 2: "labels", 3: "components"}
LINK_TYPES = {"A": 1, "N": 2, "R": 3}
LINK_NAMES = {"A": "blocks", "N": "relates to", "R": "duplicates"}
LINK_INWARD = {"A": "is blocked by", "N": "relates to", "R": "is duplicated by"}


def spelled(code: Column, names: dict) -> Column:
    """Translate a code through a fixed dictionary."""
    (first, name), *rest = names.items()
    chosen = F.when(code == first, name)
    for other, name in rest:
        chosen = chosen.when(code == other, name)
    return chosen


def _text(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key))


class SampleSource:
    """Source of raw tables over a folder of sample parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        # Sprints and versions are read off the issues; a pipeline that keeps
        # the issues in its store can offer the stored ones here.
        self.issues: Callable[[], DataFrame] = self._issues_table

    def table(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}_table")()

    @cache  # noqa: B019 - one schema lookup per file, kept as long as the source
    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _lines(self) -> DataFrame:
        month = (F.year("l_shipdate") - FIRST_YEAR) * 12 + F.month("l_shipdate")
        return self.read("lineitem").select(
            "*",
            month.alias("month_number"),
            (F.col("l_partkey") % 25 + 1).alias("component_id"),
        )

    def _issues_table(self) -> DataFrame:
        per_order = self._lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.count(F.lit(1)).alias("lines"),
            F.min("l_suppkey").alias("supplier"),
            F.max("l_shipdate").alias("last_shipped"),
            F.sum("l_quantity").alias("quantity"),
            # One set of all four, as the state of each set costs far more than its values.
            F.collect_set(
                F.struct(
                    F.col("l_returnflag").alias("flag"),
                    F.col("month_number").alias("month"),
                    F.col("component_id").alias("component"),
                    F.year("l_shipdate").alias("year"),
                )
            ).alias("seen"),
        )
        customers = self.read("customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("project")
        )
        nations = self.read("nation").select(F.col("n_nationkey").alias("project"), "n_name")
        resolved = (F.col("o_orderstatus") == "F") & F.col("last_shipped").isNotNull()
        last_change = F.greatest("o_orderdate", "last_shipped")
        priority_id = F.substring("o_orderpriority", 1, 1)
        rank = F.col("o_orderkey") % 5

        def seen(part: str, kind: str) -> Column:
            """Distinct values in order, without null; all compiled, unlike ``array_sort``."""
            nothing = F.array(F.lit(None).cast(kind))
            return F.sort_array(F.array_except(F.col(f"seen.{part}"), nothing))

        def in_project(part: str, factor: int) -> Column:
            base = F.col("project").cast("bigint") * factor
            return F.transform(seen(part, "int"), lambda number: base + number)

        return (
            self.read("orders")
            .join(per_order, "o_orderkey", "left")
            .join(customers, "o_custkey", "left")
            .join(nations, "project", "left")
            .select(
                F.col("o_orderkey").alias("id"),
                F.concat_ws("-", "n_name", "o_orderkey").alias("key"),
                F.col("n_name").alias("projectKey"),
                _text("Order ", "o_orderkey").alias("summary"),
                spelled(F.col("o_orderstatus"), STATUS_OF_ORDER).alias("status"),
                priority_id.alias("priorityId"),
                spelled(priority_id, PRIORITY_NAMES).alias("priority"),
                spelled(rank, TYPE_NAMES).alias("issueType"),
                F.when(rank != 0, F.col("o_orderkey") - rank).alias("parent_id"),
                F.col("o_orderdate").alias("created"),
                last_change.alias("updated"),
                F.when(resolved, last_change).alias("resolutionDate"),
                F.when(resolved, spelled(F.col("o_orderkey") % 3, RESOLUTION_NAMES)).alias(
                    "resolution"
                ),
                _text("C", "o_custkey").alias("reporter"),
                _text("C", "o_custkey").alias("creator"),
                _text("S", "supplier").alias("assignee"),
                F.date_add(F.col("o_orderdate").cast("date"), 45).alias("due_date"),
                seen("flag", "string").alias("labels"),
                F.col("lines").cast("double").alias("story_points"),
                (F.col("quantity") * 600).cast("bigint").alias("time_spent_seconds"),
                in_project("month", 1000).alias("sprint_ids"),
                seen("component", "bigint").alias("component_ids"),
                in_project("year", 10000).alias("fix_version_ids"),
            )
        )

    def _derived_ids(self, column: str) -> DataFrame:
        return self.issues().select(F.explode(column).alias("id")).distinct()

    def _sprints_table(self) -> DataFrame:
        month = F.col("id") % 1000 - 1
        start = F.make_date(
            (F.floor(month / 12) + FIRST_YEAR).cast("int"), (month % 12 + 1).cast("int"), F.lit(1)
        ).cast("timestamp")
        end = F.add_months(start, 1).cast("timestamp")
        now = F.lit(SAMPLE_AS_OF).cast("timestamp")
        closed = end <= now
        project = F.floor(F.col("id") / 1000)
        return self._derived_ids("sprint_ids").select(
            "id",
            (project + 1000).alias("boardId"),
            _text("Sprint ", "id").alias("name"),
            F.when(closed, "closed").when(start <= now, "active").otherwise("future").alias("state"),
            start.alias("startDate"),
            end.alias("endDate"),
            F.when(closed, end).alias("completeDate"),
            F.concat(F.lit("Ship "), F.date_format(start, "yyyy-MM")).alias("goal"),
        )

    def _version_table(self) -> DataFrame:
        year = F.col("id") % 10000
        return self._derived_ids("fix_version_ids").select(
            "id",
            F.concat(F.lit("Release "), year).alias("name"),
            F.floor(F.col("id") / 10000).alias("project_id"),
            (year < 1997).alias("archived"),
            (year < 2001).alias("released"),
            F.make_date(year.cast("int"), F.lit(12), F.lit(31)).alias("release_date"),
            F.make_date(year.cast("int"), F.lit(1), F.lit(1)).alias("start_date"),
        )

    def _projects_table(self) -> DataFrame:
        leads = (
            self.read("supplier")
            .groupBy(F.col("s_nationkey").alias("n_nationkey"))
            .agg(F.min("s_suppkey").alias("lead"))
        )
        return (
            self.read("nation")
            .join(leads, "n_nationkey", "left")
            .select(
                F.col("n_nationkey").alias("id"),
                F.col("n_name").alias("key"),
                _text("Project ", "n_nationkey").alias("name"),
                F.col("n_regionkey").alias("projectCategory"),
                F.when(F.col("n_nationkey") % 2 == 0, "software")
                .otherwise("business")
                .alias("projectTypeKey"),
                _text("S", "lead").alias("lead"),
                (F.col("n_nationkey") % 10 == 9).alias("archived"),
            )
        )

    def _customers_by_nation(self) -> DataFrame:
        return (
            self.read("customer")
            .groupBy(F.col("c_nationkey").alias("n_nationkey"))
            .agg(F.count("*").alias("customers"), F.min("c_custkey").alias("first_customer"))
        )

    def _project_categories_table(self) -> DataFrame:
        served = (
            self.read("nation")
            .join(self._customers_by_nation(), "n_nationkey")
            .groupBy(F.col("n_regionkey").alias("r_regionkey"))
            .agg(F.sum("customers").alias("customers"))
        )
        return (
            self.read("region")
            .join(served, "r_regionkey", "left")
            .select(
                F.col("r_regionkey").alias("id"),
                F.col("r_name").alias("name"),
                F.concat(F.col("customers"), F.lit(" customers")).alias("description"),
            )
        )

    def _status_table(self) -> DataFrame:
        steps = self._lines.select((F.col("l_linenumber") % 4 + 1).alias("id")).distinct()
        return steps.select(
            "id",
            spelled(F.col("id"), STATUS_NAMES).alias("name"),
            spelled(F.col("id"), STATUS_CATEGORIES).alias("status_category"),
        )

    def _status_category_table(self) -> DataFrame:
        """Categories; the done one lacks its key, which falls back to the name."""
        code = F.col("o_orderstatus")
        return (
            self.read("orders")
            .select("o_orderstatus")
            .distinct()
            .select(
                spelled(code, CATEGORY_IDS).alias("id"),
                spelled(code, CATEGORY_KEYS).alias("key"),
                spelled(code, STATUS_OF_ORDER).alias("name"),
                spelled(code, CATEGORY_COLORS).alias("color_name"),
            )
        )

    def _priority_table(self) -> DataFrame:
        code = F.substring("o_orderpriority", 1, 1)
        return (
            self.read("orders")
            .select(code.alias("code"))
            .distinct()
            .select(
                F.col("code").cast("int").alias("id"),
                spelled(F.col("code"), PRIORITY_NAMES).alias("name"),
                F.when(F.col("code") <= "2", "red").otherwise("gray").alias("status_color"),
            )
        )

    def _issue_types_table(self) -> DataFrame:
        ranks = self.read("orders").select((F.col("o_orderkey") % 5).alias("id")).distinct()
        return ranks.select(
            "id",
            spelled(F.col("id"), TYPE_NAMES).alias("name"),
            (F.col("id") == 4).alias("subtask"),
        )

    def _resolutions_table(self) -> DataFrame:
        ranks = self.read("orders").select((F.col("o_orderkey") % 3).alias("id")).distinct()
        return ranks.select("id", spelled(F.col("id"), RESOLUTION_NAMES).alias("name"))

    def _users_table(self) -> DataFrame:
        def users(table: str, prefix: str, code: str, kind: str) -> DataFrame:
            return self.read(table).select(
                _text(code, f"{prefix}_{'cust' if code == 'C' else 'supp'}key").alias("account_id"),
                F.col(f"{prefix}_name").alias("displayName"),
                F.concat(F.lower(f"{prefix}_name"), F.lit("@example.com")).alias("emailId"),
                (F.col(f"{prefix}_acctbal") >= 0).alias("active"),
                F.lit(kind).alias("accountType"),
            )

        return users("customer", "c", "C", "customer").unionByName(
            users("supplier", "s", "S", "agent")
        )

    def _user_group_table(self) -> DataFrame:
        customers = self.read("customer")
        account = _text("C", "c_custkey").alias("account_id")
        segments = customers.select(
            account,
            F.lower("c_mktsegment").alias("group_id"),
            F.col("c_mktsegment").alias("group_name"),
        )
        regional = customers.where(F.col("c_custkey") % 3 == 0).select(
            account,
            _text("nation-", "c_nationkey").alias("group_id"),
            _text("NATION ", "c_nationkey").alias("group_name"),
        )
        return segments.unionByName(regional)

    def _issue_fields_table(self) -> DataFrame:
        ranks = self._lines.select((F.col("l_linenumber") % 4).alias("rank")).distinct()
        name = spelled(F.col("rank"), FIELD_NAMES)
        several = F.col("rank") >= 2
        return ranks.select(
            name.alias("id"),
            F.initcap(name).alias("name"),
            F.lit(False).alias("custom"),
            F.when(several, "array").otherwise("string").alias("schema_type"),
            F.when(several, "string").alias("schema_items"),
        )

    def _issue_field_values_table(self) -> DataFrame:
        def values(rows: DataFrame, **fields: Column) -> DataFrame:
            entries = [
                F.struct(F.lit(field).alias("field_id"), value.cast("string").alias("field_value"))
                for field, value in fields.items()
            ]
            return rows.select(
                F.col("l_orderkey").alias("issue_id"),
                F.col("l_shipdate").alias("updated_at"),
                F.explode(F.array(*entries)).alias("entry"),
            ).select("issue_id", "entry.*", "updated_at")

        return values(
            self._lines,
            status=F.col("l_linenumber") % 4 + 1,
            assignee=_text("S", "l_suppkey"),
            labels=F.col("l_returnflag"),
            components=F.col("component_id"),
        )

    def _issue_worklogs_table(self) -> DataFrame:
        return self._lines.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            F.col("l_orderkey").alias("issueId"),
            _text("S", "l_suppkey").alias("author_id"),
            (F.col("l_quantity") * 600).cast("bigint").alias("time_spent_seconds"),
            F.col("l_shipdate").alias("started"),
            F.col("l_shipdate").alias("created"),
        )

    def _issue_comments_table(self) -> DataFrame:
        return self.read("conversations").select(
            F.concat_ws("-", "conv_id", "turn").alias("id"),
            F.col("conv_id").alias("issueId"),
            F.col("role").alias("author"),
            F.col("text").alias("body"),
        )

    def _issue_watchers_table(self) -> DataFrame:
        return self.read("events").select(
            F.col("event_id").alias("issueId"), _text("C", "user_id").alias("userId")
        )

    def _issue_links_table(self) -> DataFrame:
        flag = F.col("l_returnflag")
        order = F.col("l_orderkey")
        return self._lines.select(
            order.alias("source_issue_id"),
            F.when(order % 50 != 49, order + 1).alias("target_issue_id"),
            spelled(flag, LINK_TYPES).alias("link_type_id"),
            spelled(flag, LINK_NAMES).alias("relationship"),
            spelled(flag, LINK_INWARD).alias("inward"),
            spelled(flag, LINK_NAMES).alias("outward"),
        )

    def _boards_table(self) -> DataFrame:
        nation = F.col("n_nationkey")
        return (
            self.read("nation")
            .join(self._customers_by_nation(), "n_nationkey", "left")
            .select(
                (nation + 1000).alias("id"),
                _text("Board ", "n_name").alias("name"),
                F.when(nation % 2 == 0, "scrum").otherwise("kanban").alias("type"),
                nation.alias("projectId"),
                F.col("first_customer").alias("filterId"),
                F.lit("project").alias("location"),
            )
        )

    def _project_board_table(self) -> DataFrame:
        nation = F.col("c_nationkey")
        served = self.read("customer").select(nation).distinct()
        return served.select(nation.alias("projectId"), (nation + 1000).alias("boardId"))

    def _project_components_table(self) -> DataFrame:
        number = (F.col("p_partkey") % 25 + 1).alias("id")
        return (
            self.read("part")
            .groupBy(number)
            .agg(F.count(F.lit(1)).alias("parts"))
            .select(
                "id",
                _text("Component ", "id").alias("name"),
                F.concat(F.col("parts"), F.lit(" parts")).alias("description"),
                _text("S", "id").alias("lead"),
                (F.col("id") % 25).alias("projectId"),
                F.lit("PROJECT_LEAD").alias("assigneeType"),
            )
        )

    def _project_roles_table(self) -> DataFrame:
        roles = self.read("part").groupBy("p_type").agg(F.min("p_partkey").alias("id"))
        return roles.select(
            "id",
            F.col("p_type").alias("name"),
            _text("Works on ", "p_type").alias("description"),
        )

    def _project_role_actor_table(self) -> DataFrame:
        return self.read("supplier").select(
            F.col("s_nationkey").alias("projectId"),
            (F.col("s_suppkey") % 5).alias("roleId"),
            _text("S", "s_suppkey").alias("actorId"),
            F.lit("user").alias("actorType"),
            F.col("s_name").alias("actorName"),
        )

    def _application_roles_table(self) -> DataFrame:
        return (
            self.read("customer")
            .groupBy("c_mktsegment")
            .agg(
                F.count(F.lit(1)).alias("user_count"),
                F.count_distinct("c_nationkey").alias("group_count"),
            )
            .select(
                F.lower("c_mktsegment").alias("key"),
                F.initcap("c_mktsegment").alias("name"),
                "user_count",
                "group_count",
            )
        )

    def _permission_schemes_table(self) -> DataFrame:
        schemes = self.read("part").groupBy("p_type").agg(F.min("p_partkey").alias("id"))
        return schemes.select(
            "id",
            _text("Permissions ", "p_type").alias("name"),
            _text("Granted for ", "p_type").alias("description"),
        )

    def _security_schemes_table(self) -> DataFrame:
        schemes = self.read("part").groupBy("p_brand").agg(
            F.min("p_partkey").alias("id"), F.min("p_size").alias("level")
        )
        return schemes.select(
            "id",
            F.col("p_brand").alias("name"),
            _text("Security of ", "p_brand").alias("description"),
            F.col("level").alias("default_security_level_id"),
        )

    def _security_level_table(self) -> DataFrame:
        levels = self.read("part").groupBy("p_brand", "p_size").agg(
            F.min("p_partkey").alias("id")
        )
        return levels.select(
            "id",
            F.concat_ws("/", "p_brand", "p_size").alias("name"),
            _text("Level ", "p_size").alias("description"),
            F.col("p_size").alias("security_scheme_id"),
        )

    def _project_permissions_table(self) -> DataFrame:
        grants = self.read("customer").select("c_nationkey", "c_mktsegment").distinct()
        return grants.select(
            F.col("c_nationkey").alias("project_id"),
            F.lit("browse").alias("permission"),
            F.lit("group").alias("holder_type"),
            F.lower("c_mktsegment").alias("holder_value"),
        )
