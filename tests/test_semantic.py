import pytest
from pyspark.sql import functions as F

from flowlens.config import LayerConfig
from flowlens.semantic.model import (
    AmbiguousName,
    BoundView,
    Field,
    Join,
    Measure,
    MetricView,
    UnknownName,
    source,
)
from flowlens.semantic.views import all_views


@pytest.fixture(scope="module")
def view(spark):
    facts = spark.createDataFrame(
        [
            (1, "a", 10.0, "x"),
            (2, "a", 20.0, "x"),
            (3, "b", 5.0, "y"),
            (4, None, 1.0, "y"),
            (None, "a", 99.0, "x"),
        ],
        "id int, owner string, amount double, kind string",
    )
    owners = spark.createDataFrame(
        [("a", "Ann", "North"), ("b", "Bo", "South")], "owner string, name string, region string"
    )
    kinds = spark.createDataFrame([("x", "Ex"), ("y", "Why")], "kind string, label string")
    model = MetricView(
        name="metric_toy",
        table="facts",
        condition=source("id").isNotNull(),
        joins=(
            Join("owner_dim", "owners", source("owner"), "owner"),
            Join("kind_dim", "kinds", source("kind"), "kind"),
        ),
        fields=(
            Field("Kind", source("kind"), None, ("sort",)),
            Field("Amount", source("amount")),
            Field("Owner Name", F.col("owner_dim.name"), "owner_dim", ("who", "both")),
            Field("Region", F.col("owner_dim.region"), "owner_dim", ("both",)),
            Field("Label", F.col("kind_dim.label"), "kind_dim"),
        ),
        measures=(
            Measure("Rows", F.count(F.lit(1)), ("size",)),
            Measure("Total", F.sum(source("amount"))),
            Measure("Biggest", F.max(source("amount"))),
        ),
    )
    return BoundView(model, {"facts": facts, "owners": owners, "kinds": kinds}.__getitem__)


def table(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


def joins(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_global_measure_respects_the_view_condition(view):
    assert table(view.query((), ["Rows", "Total"])) == [(4, 36.0)]


def test_grouping_by_a_joined_field(view):
    result = view.query({"who": "Owner Name"}, {"total": "Total"})
    assert table(result) == [("Ann", 30.0), ("Bo", 5.0), (None, 1.0)]


def test_only_needed_joins_are_made(view):
    assert joins(view.query(["Kind"], ["Rows"])) == 0
    assert joins(view.query(["Region"], ["Rows"])) == 1
    assert joins(view.query(["Kind"], ["Rows"], where=lambda f: f("Label") == "Ex")) == 1
    assert joins(view.query(["Region", "Label"], ["Rows"])) == 2


def test_synonyms(view):
    assert table(view.query({"k": "SORT"}, {"n": "size"})) == [("x", 2), ("y", 2)]
    with pytest.raises(AmbiguousName, match="Owner Name, Region"):
        view.query(["both"], ["Rows"])
    with pytest.raises(UnknownName, match="Nothing"):
        view.query(["Nothing"], ["Rows"])


def test_hidden_group_and_order(view):
    result = view.query(
        {"kind": "Kind"},
        {"total": "Total"},
        grouped_by=["Owner Name"],
        order_by=["-Owner Name", "kind"],
    )
    assert [tuple(row) for row in result.collect()] == [("y", 5.0), ("x", 30.0), ("y", 1.0)]


def test_limit_with_tie_break(view):
    result = view.query(["Kind"], {"n": "Rows"}, order_by=["-n", "Kind"], limit=1)
    assert table(result) == [("x", 2)]


def test_derived_adhoc_and_having(view):
    result = view.query(
        {"kind": "Kind"},
        {"n": "Rows"},
        adhoc={"lowest": lambda f: F.min(f("Amount"))},
        derived={
            "rest": lambda v: v("Total") - v("Biggest"),
            "is_x": lambda v: v("Kind") == "x",
        },
        having=lambda v: v("Total") > 10,
    )
    assert result.columns == ["kind", "n", "lowest", "rest", "is_x"]
    assert table(result) == [("x", 2, 10.0, 10.0, True)]


def test_derived_may_not_use_an_ungrouped_field(view):
    with pytest.raises(UnknownName):
        view.query(["Kind"], ["Rows"], derived={"odd": lambda v: v("Amount")})


def test_rows(view):
    result = view.rows(
        {"k": "Kind", "who": "Owner Name"},
        where=lambda f: f("Amount") > 4,
        derived={"twice": lambda f: f("Amount") * 2},
    )
    assert table(result) == [("x", "Ann", 20.0), ("x", "Ann", 40.0), ("y", "Bo", 10.0)]


def test_size_of_the_model(spark):
    views = all_views(LayerConfig(as_of="2020-01-01 00:00:00"))
    fields = {name: len(view.fields) for name, view in views.items()}
    measures = {name: len(view.measures) for name, view in views.items()}
    assert sum(fields.values()) == 83 and sum(measures.values()) == 72
    assert sum(len(view.joins) for view in views.values()) == 18
    assert fields["metric_issue"] == 37 and measures["metric_issue"] == 23


def test_every_synonym_is_unambiguous(spark):
    for view in all_views(LayerConfig()).values():
        for field in view.fields:
            for synonym in (field.name, *field.synonyms):
                assert view.field(synonym) is field
        for measure in view.measures:
            for synonym in (measure.name, *measure.synonyms):
                assert view.measure(synonym) is measure
