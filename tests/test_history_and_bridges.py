from flowlens.operators import bridges, history
from flowlens.operators.projections import PROJECTIONS
from flowlens.sources.readers import FileSource


def pairs(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_history_is_split_by_field_type(spark):
    values = spark.createDataFrame(
        [(1, "status", "3"), (1, "labels", "x"), (1, "labels", "y"), (1, "unknown", "z")],
        "issue_id long, field_id string, field_value string",
    )
    fields = spark.createDataFrame(
        [("status", "string"), ("labels", "array"), ("labels", "array")],
        "id string, schema_type string",
    )
    single = history.single_value_history(values, fields)
    several = history.multi_value_history(values, fields)
    assert sorted(row.field_id for row in single.collect()) == ["status", "unknown"]
    assert sorted(row.value for row in several.collect()) == ["x", "y"]
    assert single.first().is_current is True
    assert dict(single.dtypes)["updated_at"] == "timestamp"


def test_explode_drops_nulls_and_repeats(spark):
    issues = spark.createDataFrame(
        [(1, [5, 5, None, 6]), (2, []), (3, None), (1, [5])], "id long, sprint_ids array<long>"
    )
    assert pairs(bridges.sprint_issue(issues)) == [(5, "1"), (6, "1")]


def test_struct_and_text_elements(spark):
    structs = spark.createDataFrame(
        [(1, [(5, "api")])], "id long, components array<struct<id:long,name:string>>"
    )
    assert pairs(bridges.issue_component(structs)) == [("1", 5)]
    texts = spark.createDataFrame([(1, ["7", "api"])], "id long, components array<string>")
    names = spark.createDataFrame([(9, "api", 3)], "id long, name string, project_id long")
    homes = spark.createDataFrame([("1", 3)], "id string, project_id long")
    assert pairs(bridges.issue_component(texts, names, homes)) == [("1", 7), ("1", 9)]


def test_names_count_within_the_project_only(spark):
    issues = spark.createDataFrame(
        [(1, ["UI"]), (2, ["UI"]), (3, ["UI"])], "id long, components array<string>"
    )
    homes = spark.createDataFrame([("1", 10), ("2", 20)], "id string, project_id long")
    names = spark.createDataFrame(
        [(7, "UI", 10), (8, "UI", 20)], "id long, name string, project_id long"
    )
    assert pairs(bridges.issue_component(issues, names, homes)) == [("1", 7), ("2", 8)]
    fixed = issues.withColumnRenamed("components", "fix_versions")
    versions, owners = names.drop("project_id"), names.selectExpr("id version_id", "project_id")
    assert pairs(bridges.issue_version(fixed, versions, owners, homes)) == [("1", 7), ("2", 8)]


def test_missing_array_gives_an_empty_typed_bridge(spark):
    issues = spark.createDataFrame([(1,)], "id long")
    for frame, schema in (
        (bridges.sprint_issue(issues), {"sprint_id": "bigint", "issue_id": "string"}),
        (bridges.issue_version(issues), {"issue_id": "string", "version_id": "bigint"}),
        (
            bridges.epic_issue(issues, issues, "epic"),
            {"epic_id": "string", "issue_id": "string"},
        ),
    ):
        assert dict(frame.dtypes) == schema
        assert frame.count() == 0


def test_epics_by_type_name_or_id(spark):
    types = spark.createDataFrame([(1, "EPIC"), (2, "Bug")], "id int, name string")
    by_name = spark.createDataFrame(
        [(10, None, "EPIC"), (11, 10, "Bug"), (12, 11, "Bug"), (11, 10, "Bug"), (13, 99, "Bug")],
        "id long, parentId long, issueType string",
    )
    assert pairs(bridges.epic_issue(by_name, types, "epic")) == [("10", "11")]
    by_id = spark.createDataFrame(
        [(10, None, 1), (11, 10, 2)], "id long, parent_id long, issue_type_id int"
    )
    assert pairs(bridges.epic_issue(by_id, types, "Epic")) == [("10", "11")]


def test_link_id_skips_missing_parts(spark):
    links = spark.createDataFrame(
        [(1, 2, "blocks", "Blocks"), (1, None, "blocks", "Blocks")],
        "source_issue_id long, target_issue_id long, relationship string, link_type_name string",
    )
    rows = bridges.issue_link(links).collect()
    assert sorted(row.id for row in rows) == ["1-2-blocks", "1-blocks"]
    kinds = PROJECTIONS["issue_link_type"].build(links).collect()
    assert [row.name for row in kinds] == ["Blocks"]


def test_arrays_of_text_formats_are_json(spark, tmp_path):
    """CSV has no arrays: JSON text is read as one, other text has no elements."""
    lines = ["id;sprint_ids;fix_versions", '1;[4, 5];["Next"]', "2;;[]", "3;no list;[7]", '4;["6"];null']
    (tmp_path / "issues_without_deletes.csv").write_text("\n".join(lines))
    source = FileSource(spark, str(tmp_path), "csv", {"header": "true", "sep": ";"}, ".csv")
    issues = source.table("issues")
    assert dict(issues.dtypes)["sprint_ids"] == "string"
    assert sorted(map(tuple, bridges.sprint_issue(issues).collect())) == [(4, "1"), (5, "1"), (6, "4")]
    versions = spark.createDataFrame([(9, "Next")], "id long, name string")
    owners = spark.createDataFrame([(9, 1)], "version_id long, project_id long")
    homes = spark.createDataFrame([("1", 1)], "id string, project_id long")
    found = bridges.issue_version(issues, versions, owners, homes)
    assert sorted(map(tuple, found.collect())) == [("1", 9), ("3", 7)]
