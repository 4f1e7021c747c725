"""Silver field history, split by whether a field holds one value or several."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.sources.columns import Target, project

# History columns and their source spellings.
_HISTORY = (
    Target("issue_id", "string", ("issue_id",), required=True),
    Target("field_id", "string", ("field_id",), required=True),
    Target("value", "string", ("field_value", "value")),
    Target("updated_at", "timestamp", ("updated_at", "ingestion_timestamp", "created", "updated")),
    Target("is_current", "boolean", ("is_current",), default=True),
)


def multi_value_fields(fields: DataFrame) -> DataFrame:
    """Ids of the fields whose schema says they hold an array."""
    described = project(
        fields,
        [
            Target("field_id", "string", ("id", "key")),
            Target("schema_type", "string", ("schema_type", "type")),
        ],
    )
    return described.where(F.col("schema_type") == "array").select("field_id")


def single_value_history(values: DataFrame, fields: DataFrame) -> DataFrame:
    return project(values, _HISTORY).join(multi_value_fields(fields), "field_id", "left_anti").select(
        *[target.name for target in _HISTORY]
    )


def multi_value_history(values: DataFrame, fields: DataFrame) -> DataFrame:
    return project(values, _HISTORY).join(multi_value_fields(fields), "field_id", "left_semi").select(
        *[target.name for target in _HISTORY]
    )
