"""Run settings: where the layers live and how tracker-specific terms are spelled."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Source tables that land under another name.
BRONZE_ALIASES = {"issues": "issues_without_deletes"}


@dataclass(frozen=True)
class LayerConfig:
    """Settings of one run.

    ``as_of`` is the moment every "now" in the marts refers to, as a timestamp
    string read in the session time zone.  Left unset, the clock of the query is
    used, so results move with the day they are computed on.
    """

    as_of: str | None = None
    catalog: str = ""
    bronze_catalog: str = ""
    bronze_schema: str = "bronze"
    silver_catalog: str = ""
    silver_schema: str = "silver"
    gold_catalog: str = ""
    gold_schema: str = "gold"
    status_field_id: str = "status"
    in_progress_category_key: str = "indeterminate"
    epic_issue_type_name: str = "epic"

    @classmethod
    def from_conf(cls, spark: SparkSession, **overrides) -> LayerConfig:
        """Read every setting that the session configuration names."""
        found = {}
        for field in fields(cls):
            value = spark.conf.get(field.name, None)
            if value:
                found[field.name] = value
        return cls(**{**found, **overrides})

    def table_name(self, layer: str, table: str) -> str:
        """Qualified name of a table; a layer without a catalog uses the shared one."""
        if layer == "bronze":
            table = BRONZE_ALIASES.get(table, table)
        catalog = getattr(self, f"{layer}_catalog") or self.catalog
        parts = [catalog, getattr(self, f"{layer}_schema"), table]
        return ".".join(f"`{part}`" for part in parts if part)

    def now(self) -> Column:
        if self.as_of is None:
            return F.current_timestamp()
        return F.lit(self.as_of).cast("timestamp")

    def today(self) -> Column:
        return self.now().cast("date")

    def days_ago(self, days: int) -> Column:
        return F.date_sub(self.today(), days)
