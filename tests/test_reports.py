import pytest
from pyspark.sql import functions as F

from flowlens.config import LayerConfig
from flowlens.plans import gadgets
from flowlens.plans.datasets import DATASETS, as_series
from flowlens.plans.questions import QUESTIONS
from flowlens.semantic.layer import MetricLayer
from sampleset.queries import workspace

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layer(spark) -> MetricLayer:
    return workspace(spark, SMALL)


def test_numbers_of_reports():
    assert len(DATASETS) == 15
    assert sum(len(counters) for counters in gadgets.COUNTERS.values()) == 21
    assert len(QUESTIONS) == 20


def test_only_listed_aggregates():
    with pytest.raises(ValueError, match="MEDIAN"):
        gadgets.aggregate("MEDIAN", "x")


def test_rollup_with_selection(spark):
    frame = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("b", 5, "x")], "k string, n int, s string"
    )
    totals = {"total": ("SUM", "n"), "rows": ("COUNT", "*"), "top": ("MAX", "n")}

    def rows(filters):
        return sorted(tuple(r) for r in gadgets.rollup(frame, ["k"], totals, filters).collect())

    assert rows(None) == [("a", 3, 2, 2), ("b", 5, 1, 5)]
    assert rows({"k": [], "other": ["z"]}) == rows(None)
    assert rows({"s": ["x"], "k": ["a", "b"]}) == [("a", 1, 1, 1), ("b", 5, 1, 5)]


def test_series_come_from_one_pass(spark):
    frame = spark.createDataFrame([("w1", 3, 1)], "week string, made int, done int")
    rows = as_series(frame, ["week"], {"made": "Made", "done": "Done"}, "issues").collect()
    assert [tuple(r) for r in rows] == [("w1", "Made", 3), ("w1", "Done", 1)]


def test_selectors_reach_only_their_datasets():
    choices = {"assignee_name": ["x"], "project_key": ["p"]}
    assert gadgets.selected("team", "ds_team_prod", choices) == {"assignee_name": ["x"]}
    assert gadgets.selected("team", "ds_worklog", choices) == {"project_key": ["p"]}


def test_open_totals_agree(layer):
    direct, through = (row.value for row in gadgets.check_open_total(layer).collect())
    counted = gadgets.check_open_by_priority(layer).agg(F.sum("count")).first()[0]
    assert direct == through == counted


def test_created_flow_counts_every_issue(layer):
    total = layer.table("created_resolved_daily").agg(F.sum("created_issues")).first()[0]
    assert total == layer.pipeline.gold("fct_issue").count()


def test_shared_tables_of_the_views_are_reached_by_sql(spark, layer):
    assert layer.publish() == ["vw_created_resolved_daily"]
    counted = spark.sql("SELECT sum(resolved_issues) FROM vw_created_resolved_daily").first()[0]
    assert counted == layer.pipeline.gold("fct_issue").where("is_resolved").count()


def test_missing_cycle_time_falls_into_the_last_bucket(layer):
    rows = DATASETS["ds_issue_resolved_180"](layer)
    missing = rows.where(F.col("cycle_time_days").isNull())
    assert {r.cycle_bucket for r in missing.select("cycle_bucket").distinct().collect()} <= {"90d+"}


def test_without_a_fixed_moment_the_clock_is_used(spark):
    config = LayerConfig()
    row = spark.range(1).select(
        (config.today() == F.current_date()).alias("same"),
        F.datediff(config.today(), config.days_ago(30)).alias("days"),
    ).first()
    assert row.same and row.days == 30
