import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowlens.operators import entities
from flowlens.operators.entities import attach_by_id_or_name
from flowlens.operators.expectations import enforce
from flowlens.operators.projections import EXPECTATIONS


def frames(spark, issues=None, issue_schema=None, statuses=None):
    return {
        "issues": spark.createDataFrame(
            issues
            or [(1, "A-1", "A", "Done", "1", "Critical", "Bug", "Fixed", "2020-01-01T10:00:00")],
            issue_schema
            or (
                "id long, key string, projectKey string, status string, priorityId string, "
                "priority string, issueType string, resolution string, created string"
            ),
        ),
        "projects": spark.createDataFrame([(7, "A")], "id int, key string"),
        "statuses": spark.createDataFrame(statuses or [(3, "Done")], "id int, name string"),
        "priorities": spark.createDataFrame(
            [(1, "Critical"), (5, "Low")], "id int, name string"
        ),
        "issue_types": spark.createDataFrame([(2, "Bug")], "id int, name string"),
        "resolutions": spark.createDataFrame([(9, "Fixed")], "id int, name string"),
    }


def test_names_become_ids(spark):
    row = entities.issue(**frames(spark)).first()
    assert (row.project_id, row.status_id, row.priority_id) == (7, 3, 1)
    assert (row.issue_type_id, row.resolution_id) == (2, 9)
    assert row.id == "1"
    assert row.created_at.isoformat() == "2020-01-01T10:00:00"


def test_unmatched_names_give_null_ids(spark):
    issues = [(1, "A-1", "Z", "Lost", "8", "None", "Odd", None, None)]
    row = entities.issue(**frames(spark, issues)).first()
    assert row.project_id is None and row.status_id is None and row.priority_id is None
    assert row.issue_type_id is None and row.resolution_id is None


def test_id_and_name_of_two_priorities_give_two_rows(spark):
    issues = [(1, "A-1", "A", "Done", "1", "Low", "Bug", "Fixed", None)]
    rows = entities.issue(**frames(spark, issues)).collect()
    assert sorted(row.priority_id for row in rows) == [1, 5]


def test_a_repeated_lookup_name_repeats_the_issue(spark):
    rows = entities.issue(**frames(spark, statuses=[(3, "Done"), (4, "Done")])).collect()
    assert sorted(row.status_id for row in rows) == [3, 4]


@pytest.mark.parametrize(
    ("schema", "row"),
    [
        ("id long, key string, projectKey string, created timestamp", (1, "K", "A", None)),
        ("id long, issue_key string, project_key string, created_at string", (1, "K", "A", None)),
        ("id string, key string", ("1", "K")),
    ],
)
def test_spellings_give_one_schema(spark, schema, row):
    result = entities.issue(**frames(spark, [row], schema))
    assert tuple(result.columns) == entities.ISSUE_LAYOUT
    assert "void" not in dict(result.dtypes).values()
    assert result.first().issue_key == "K"


def test_null_issue_id_stops_the_run(spark):
    issues = [(None, "A-1", "A", "Done", "1", "Critical", "Bug", "Fixed", None)]
    guarded = enforce(entities.issue(**frames(spark, issues)), "issue", EXPECTATIONS["issue"])
    with pytest.raises(PySparkException, match="issue_id_not_null"):
        guarded.collect()


def test_or_join_equals_brute_force(spark):
    dice = random.Random(5)
    ids = [None, "1", "2", "3", "4"]
    names = [None, "a", "b", "c"]
    rows = [(n, dice.choice(ids), dice.choice(names)) for n in range(200)]
    lookup = [(dice.choice([None, 1, 2, 3]), dice.choice(names)) for _ in range(12)]
    lookup += lookup[:3]
    expected = []
    for number, row_id, row_name in rows:
        hits = [
            entry_id
            for entry_id, entry_name in lookup
            if (row_id is not None and entry_id is not None and str(entry_id) == row_id)
            or (row_name is not None and entry_name == row_name)
        ]
        expected += [(number, hit) for hit in hits or [None]]
    result = attach_by_id_or_name(
        spark.createDataFrame(rows, "n int, row_id string, row_name string"),
        spark.createDataFrame(lookup, "id int, name string"),
        "row_id",
        "row_name",
        "match",
    )
    found = [(row.n, row.match) for row in result.select("n", "match").collect()]

    def order(pair):
        return pair[0], pair[1] is not None, pair[1] or 0

    assert sorted(found, key=order) == sorted(expected, key=order)


def test_category_keys(spark):
    named = spark.createDataFrame(
        [(1, "To Do"), (2, "In Progress"), (3, "Done"), (4, "Blocked")], "id int, name string"
    )
    keys = {row.name: row.category_key for row in entities.status_category(named).collect()}
    assert keys == {
        "To Do": "new",
        "In Progress": "indeterminate",
        "Done": "done",
        "Blocked": "blocked",
    }
    keyed = named.withColumn("key", F.when(F.col("id") < 3, F.lit("own")))
    keys = {row.name: row.category_key for row in entities.status_category(keyed).collect()}
    assert keys["To Do"] == "own" and keys["Done"] == "done"


def test_status_category_is_found_by_name(spark):
    statuses = spark.createDataFrame(
        [(1, "Open", "To Do"), (2, "Odd", "Nowhere")],
        "id int, name string, status_category_id string",
    )
    categories = spark.createDataFrame([(20, "To Do")], "id int, name string")
    found = {r.name: r.status_category_id for r in entities.status(statuses, categories).collect()}
    assert found == {"Open": 20, "Odd": None}
