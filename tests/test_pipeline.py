import pytest
from pyspark.sql import functions as F

from flowlens.config import LayerConfig
from flowlens.plans.pipeline import GOLD, SILVER, Pipeline
from flowlens.sources.readers import CatalogSource, FileSource, FrameSource
from flowlens.sources.sample import LANDED, SAMPLE_AS_OF, SampleSource
from flowlens.sources.sinks import CatalogStore, FolderStore

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pipeline(spark, tmp_path_factory):
    source = SampleSource(spark, SMALL)
    built = Pipeline(
        source,
        LayerConfig(as_of=SAMPLE_AS_OF),
        FolderStore(spark, str(tmp_path_factory.mktemp("marts"))),
        landed=LANDED,
    )
    source.issues = lambda: built.bronze("issues")
    return built


def test_size_of_the_layers():
    assert len(SILVER) == 36
    assert len(GOLD) == 13


def test_build_writes_every_table_once(pipeline):
    names = pipeline.build()
    assert len(names) == 49
    again = pipeline.build()
    assert again == names
    assert pipeline.gold("fct_issue") is pipeline.gold("fct_issue")


def test_one_fact_row_per_issue(pipeline):
    facts, issues = pipeline.gold("fct_issue"), pipeline.silver("issue")
    assert facts.count() == issues.count() == facts.select("issue_id").distinct().count()


def test_open_and_resolved_make_all(pipeline):
    row = pipeline.gold("agg_project_health").agg(
        F.sum("total_issues").alias("all"), F.sum(F.col("open_issues") + F.col("resolved_issues"))
    ).first()
    assert row[0] == row[1] == pipeline.gold("fct_issue").count()


def test_transitions_chain(pipeline):
    """Each exit is the entry of the next status, and names its predecessor."""
    rows = pipeline.gold("fct_issue_transitions")
    exits = rows.where(F.col("exited_at").isNotNull()).select(
        "issue_id", F.col("exited_at").alias("entered_at"), F.col("to_status_id").alias("before")
    )
    assert rows.join(exits, ["issue_id", "entered_at"]).where(
        F.col("from_status_id").eqNullSafe(F.col("before"))
    ).count() == exits.count()


def test_failed_table_is_retried(spark):
    calls = []

    def missing_then_there():
        calls.append(1)
        if len(calls) == 1:
            raise ValueError("not landed yet")
        return spark.createDataFrame([(1, "x")], "id int, name string")

    pipeline = Pipeline(FrameSource({"priority": missing_then_there}))
    with pytest.raises(ValueError, match="not landed"):
        pipeline.silver("priority")
    assert pipeline.silver("priority").count() == 1


@pytest.mark.parametrize("fmt", ["json", "parquet", "orc"])
def test_raw_tables_from_files(spark, tmp_path, fmt):
    frame = spark.createDataFrame([(1, "High"), (None, "Lost")], "id int, name string")
    frame.write.format(fmt).save(str(tmp_path / "priority"))
    pipeline = Pipeline(FileSource(spark, str(tmp_path), fmt))
    assert [tuple(r)[:2] for r in pipeline.silver("priority").collect()] == [(1, "High")]


def test_issue_source_lands_under_another_name(spark, tmp_path):
    spark.createDataFrame([(1, [4])], "id int, sprint_ids array<int>").write.parquet(
        str(tmp_path / "issues_without_deletes")
    )
    pipeline = Pipeline(FileSource(spark, str(tmp_path)))
    assert [tuple(r) for r in pipeline.silver("sprint_issue").collect()] == [(4, "1")]


def test_catalog_source_and_bucketed_store(spark):
    """Tables land in and come from catalog schemas; issue-keyed ones join without a shuffle."""
    config = LayerConfig(
        as_of=SAMPLE_AS_OF, bronze_schema="raw_t", silver_schema="silver_t", gold_schema="gold_t"
    )
    for schema in ("raw_t", "silver_t", "gold_t"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    raw = SampleSource(spark, SMALL)
    for name in (
        "issues projects status status_category priority issue_types resolutions users "
        "sprints boards issue_field_values issue_fields project_categories"
    ).split():
        raw.table(name).write.mode("overwrite").saveAsTable(config.table_name("bronze", name))
    raw.issues = lambda: spark.read.table(config.table_name("bronze", "issues"))
    pipeline = Pipeline(CatalogSource(spark, config), config, CatalogStore(spark, config, buckets=4))
    facts = pipeline.gold("fct_issue")
    assert facts.count() == 1500
    described = spark.sql("DESCRIBE EXTENDED silver_t.issue").collect()
    properties = {row.col_name: row.data_type for row in described}
    assert properties["Num Buckets"] == "4"
    assert "quality=silver" in properties["Table Properties"]

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("silver_t.issue").join(
            spark.table("silver_t.epic_issue"), F.col("id") == F.col("issue_id"), "left"
        )
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_audit_names_every_expectation(pipeline):
    rows = pipeline.audit().collect()
    assert len(rows) == 23
    assert sum(row.action == "fail" for row in rows) == 3
    links = next(row for row in rows if row.table_name == "issue_link")
    assert links.failed > 0
    assert links.passed == pipeline.silver("issue_link").count()
