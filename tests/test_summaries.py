"""Stored states merged to coarser grains against the rows themselves."""

import random

import pytest
from pyspark.sql import functions as F

from flowlens.plans import gadgets
from flowlens.plans.datasets import DATASETS, SLICES, issue_medians_merged
from flowlens.semantic import states
from flowlens.semantic.summary import UnknownGrain
from sampleset.queries import workspace

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layer(spark):
    return workspace(spark, SMALL)


def rows_of(frame, *keys):
    return sorted((tuple(row) for row in frame.collect()), key=str)


def close(left, right):
    return left == right or (left is not None and right is not None and abs(float(left) - float(right)) < 1e-6)


@pytest.mark.parametrize(
    ("name", "fields"),
    [
        ("issue", []),
        ("issue", ["Project Key"]),
        ("issue", ["Priority", "Is Resolved"]),
        ("issue_transitions", ["From Status", "To Status", "Project Key"]),
        ("issue_transitions", ["To Status", "Project Name"]),
    ],
)
def test_every_measure_merges_to_the_direct_result(layer, name, fields):
    """The sample has fewer values than a sketch keeps, so percentiles are exact too."""
    view = layer.view(name)
    measures = [one.name for one in view.view.measures if one.state]
    assert len(measures) == len(view.view.measures)
    direct = rows_of(view.query(fields, measures))
    merged = rows_of(layer.summary(name).query(fields, measures))
    assert len(direct) == len(merged)
    for one, other in zip(direct, merged):
        assert all(map(close, one, other)), (one, other)


def test_all_transitions_at_once(layer):
    """More values than a sketch keeps: counts and means are exact, percentiles within the error."""
    names = ["Transition Count", "Avg Duration (hours)", "Median Duration (hours)", "P90 Duration (hours)"]
    direct = layer.view("issue_transitions").query((), names).first()
    merged = layer.summary("issue_transitions").query((), names).first()
    assert merged[0] == direct[0] > states.SKETCH and close(merged[1], direct[1])
    hours = layer.pipeline.gold("fct_issue_transitions").select("duration_hours").where("duration_hours IS NOT NULL")
    values = sorted(float(row[0]) for row in hours.collect())
    for found, share in zip(merged[2:], (0.5, 0.9)):
        below = sum(v < float(found) for v in values) / len(values)
        upto = sum(v <= float(found) for v in values) / len(values)
        assert below - states.rank_error() <= share <= upto + states.rank_error()


def test_fields_alone_and_writing_all(layer):
    found = layer.summary("issue").query(["Project Key"])
    assert rows_of(found) == rows_of(layer.view("issue").query(["Project Key"], ["Issue Count"]).select("Project Key"))
    assert layer.summarise() == ["issue", "issue_transitions"]
    assert "summary.issue" in layer.pipeline.store.catalogue.current().tables


def test_conditions_and_synonyms(layer):
    where = lambda f: f("Is Resolved") & (f("Priority") == "High")
    direct = layer.view("issue").query({"p": "proj"}, {"n": "tickets"}, where=where, order_by=["-n", "p"])
    merged = layer.summary("issue").query({"p": "proj"}, {"n": "tickets"}, where=where, order_by=["-n", "p"])
    assert [tuple(r) for r in direct.collect()] == [tuple(r) for r in merged.collect()]


def test_medians_of_the_report(layer):
    assert rows_of(issue_medians_merged(layer)) == rows_of(DATASETS["ds_issue_medians"](layer))


def test_what_is_not_kept_is_refused(layer):
    summary = layer.summary("issue")
    with pytest.raises(UnknownGrain, match="not kept by 'Assignee'"):
        summary.query(["Assignee"], ["Issue Count"])
    with pytest.raises(UnknownGrain, match="not kept by"):
        summary.query([], ["Issue Count"], where=lambda f: f("Age (days)") > 3)


def test_a_summary_is_read_instead_of_the_fact(layer):
    layer.summary("issue").rows()
    found = layer.summary("issue").query(["Priority"], ["Open Issues"])
    assert all("/summary/issue/" in file for file in found.inputFiles())
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Only the states asked for are read.
    assert plan.split("ReadSchema:")[1].split("\n")[0].count("state_") == 1


def test_counts_of_no_rows_are_zero(layer):
    nothing = layer.summary("issue").query((), ["Issue Count", "Avg Age (days)"], where=lambda f: F.lit(False))
    assert [tuple(r) for r in nothing.collect()] == [(0, None)]


@pytest.mark.parametrize("k", [100, 400])
def test_merged_sketches_keep_their_stated_error(spark, k):
    rng = random.Random(k)
    values = sorted(rng.gauss(100, 30) for _ in range(40_000))
    frame = spark.createDataFrame([(i % 97, v) for i, v in enumerate(values)], "part int, v double").repartition(8)
    for share in (0.1, 0.5, 0.9):
        state = states.quantile(F.col("v"), share, k=k)
        stored = frame.groupBy("part").agg(*[column.alias(name) for name, column in state.stored.items()])
        merged = stored.agg(*[state.merge[name](F.col(name)).alias(name) for name in state.stored])
        found = merged.select(state.value(F.col).alias("q")).first().q
        rank = sum(v <= found for v in values) / len(values)
        assert abs(rank - share) <= states.rank_error(k)


def test_selectors_read_each_table_once(layer):
    """Five of the flow section's datasets are conditions on two tables."""
    for section, tables in (("flow", 2), ("portfolio", 2)):
        plan = gadgets.selector_values(layer, section, "project_key")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == tables, plan


@pytest.mark.parametrize("section", list(gadgets.SELECTORS))
def test_selector_values_are_those_of_the_datasets(layer, section):
    for column, datasets in gadgets.SELECTORS[section].items():
        want = {
            (row[0], dataset)
            for dataset in datasets
            for row in DATASETS[dataset](layer).select(column).distinct().collect()
        }
        found = {(row[0], row.dataset) for row in gadgets.selector_reach(layer, section, column).collect()}
        assert found == want
        values = {row[0] for row in gadgets.selector_values(layer, section, column).collect()}
        assert values == {value for value, _ in want}


def test_slices_name_datasets():
    assert set(SLICES) <= set(DATASETS)


@pytest.mark.parametrize(("section", "tables"), [("flow", 1), ("portfolio", 2), ("team", 3)])
def test_counters_read_each_gold_table_once(layer, section, tables):
    plan = gadgets.counters(layer, section)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == tables, plan


@pytest.mark.parametrize("section", list(gadgets.COUNTERS))
@pytest.mark.parametrize("choices", [None, {"project_key": ["NATION_3", "NATION_7"]}, {"project_key": ["none"]}])
def test_counters_equal_the_aggregates_of_their_datasets(layer, section, choices):
    found = {row.counter: row.value for row in gadgets.counters(layer, section, choices).collect()}
    assert len(found) == len(gadgets.COUNTERS[section])
    for counter in gadgets.COUNTERS[section]:
        rows = gadgets.filtered(DATASETS[counter.dataset](layer), gadgets.selected(section, counter.dataset, choices))
        want = rows.agg(gadgets.aggregate(counter.function, counter.column).cast("double")).first()[0]
        assert close(found[counter.title], want), counter
