import pytest
from pyspark.sql import types as T

from flowlens.config import LayerConfig
from flowlens.sources.columns import MissingColumn, Target, present_name, project


def test_first_present_spelling_wins(spark):
    frame = spark.createDataFrame([("a", "b")], "issue_key string, key string")
    row = project(frame, [Target("issue_key", "string", ("key", "issue_key"))]).first()
    assert row.issue_key == "b"


def test_missing_column_is_a_typed_null(spark):
    frame = spark.createDataFrame([(1,)], "id int")
    result = project(frame, [Target("id", "string", ("id",), required=True), Target("icon_url", "string", ("icon_url",))])
    assert result.schema["icon_url"].dataType == T.StringType()
    assert result.first().asDict() == {"id": "1", "icon_url": None}


def test_default_is_used_when_no_source_is_present(spark):
    frame = spark.createDataFrame([(1,)], "id int")
    target = Target("is_current", "boolean", ("is_current",), default=True)
    assert project(frame, [target]).first().is_current is True


def test_required_column_must_exist(spark):
    frame = spark.createDataFrame([(1,)], "other int")
    with pytest.raises(MissingColumn, match="id"):
        project(frame, [Target("id", "bigint", ("id",), required=True)])


def test_names_are_matched_exactly():
    assert present_name(["resolutiondate"], ("resolutionDate", "resolutiondate")) == "resolutiondate"
    assert present_name(["KEY"], ("key",)) is None


def test_layer_names_fall_back_to_the_shared_catalog():
    config = LayerConfig(catalog="shared", silver_catalog="own", bronze_schema="landing")
    assert config.table_name("bronze", "issues") == "`shared`.`landing`.`issues_without_deletes`"
    assert config.table_name("silver", "issue") == "`own`.`silver`.`issue`"


def test_settings_come_from_the_session(spark):
    spark.conf.set("epic_issue_type_name", "initiative")
    try:
        config = LayerConfig.from_conf(spark, as_of="2020-01-01 00:00:00")
    finally:
        spark.conf.unset("epic_issue_type_name")
    assert config.epic_issue_type_name == "initiative"
    assert config.as_of == "2020-01-01 00:00:00"
    assert config.status_field_id == "status"
