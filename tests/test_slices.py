"""What a build has on disk at once: facts written in slices, shuffle files, the codec of stored tables."""

import time

import pytest
from pyspark.sql import functions as F

from flowlens.config import LayerConfig
from flowlens.plans.pipeline import Pipeline
from flowlens.sources.readers import FrameSource
from flowlens.sources.sinks import FolderStore, freeing_shuffles

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
FACTS = ("fct_issue", "fct_issue_transitions", "fct_worklog")


def raw(spark):
    """Twenty issues, one of them twice, with history and worklogs, some of them of no issue."""

    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    issues = [
        (str(n), f"K-{n}", "K", "To Do" if n % 2 else "Done", "1", "High", "Epic" if n % 5 == 0 else "Bug",
         str(n - n % 5) if n % 5 else None, f"2020-01-{n + 1:02}", f"2020-02-{n + 1:02}" if n % 2 == 0 else None, "U1", [1, 2] if n % 3 else None)
        for n in [*range(20), 7]
    ]
    values = [(str(n % 20) if n < 90 else None, "status", str(n % 4 + 1), f"2020-01-{n % 28 + 1:02}") for n in range(100)]
    logs = [(f"w{n}", str(n % 23) if n % 9 else None, "U1" if n % 2 else None, 60 * n, "2020-01-05") for n in range(60)]
    named = "id long, name string"
    return FrameSource({
        "issues": table(issues, "id string, key string, projectKey string, status string, priorityId string, priority string, "
                        "issueType string, parent_id string, created string, resolutionDate string, assignee string, sprint_ids array<long>"),
        "projects": table([(1, "K", "Kay")], "id long, key string, name string"),
        "status": table([(n, s, c) for n, s, c in ((1, "To Do", "To Do"), (2, "Doing", "In Progress"), (4, "Done", "Done"))],
                        "id long, name string, status_category string"),
        "status_category": table([(2, "To Do", "new"), (3, "In Progress", "indeterminate"), (4, "Done", "done")], f"{named}, key string"),
        "priority": table([(1, "High")], named),
        "issue_types": table([(1, "Epic"), (2, "Bug")], named),
        "resolutions": table([(1, "Done")], named),
        "users": table([("U1", "Una")], "account_id string, displayName string"),
        "boards": table([(1, "B", 1)], f"{named}, projectId long"),
        "sprints": table([(1, 1, "S1", "closed"), (2, 1, "S2", "active")], "id long, boardId long, name string, state string"),
        "issue_fields": table([("status", "string")], "id string, schema_type string"),
        "issue_field_values": table(values, "issue_id string, field_id string, field_value string, updated_at string"),
        "issue_worklogs": table(logs, "id string, issueId string, author_id string, time_spent_seconds long, started string"),
    })


def built(spark, root, slices):
    pipeline = Pipeline(raw(spark), LayerConfig(as_of="2020-06-01 00:00:00"), FolderStore(spark, str(root), slices))
    return {name: pipeline.gold(name) for name in FACTS}


def test_slices_hold_the_rows_of_the_whole(spark, tmp_path):
    whole, sliced = built(spark, tmp_path / "whole", 1), built(spark, tmp_path / "sliced", 3)
    for name in FACTS:
        rows = sorted(map(str, whole[name].collect()))
        assert rows and sorted(map(str, sliced[name].collect())) == rows
        writes = [len({file.split("part-")[1][6:42] for file in frame.inputFiles()}) for frame in (whole[name], sliced[name])]
        assert writes == [1, 3], name
    assert whole["fct_issue"].where("issue_id = '7'").count() == 2
    assert whole["fct_worklog"].where("issue_id is null").count() == 7


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        found = blocks.getAllFiles().mkString("\n").split("\n")
        return {file for file in found if "/shuffle_" in file}

    before = shuffles()
    frame = spark.range(1000).repartition(3, "id")
    FolderStore(spark, str(tmp_path)).save("silver.some", frame)
    for _ in range(50):
        if not shuffles() - before:
            return
        time.sleep(0.2)
    pytest.fail(f"left: {shuffles() - before}")


def test_the_setting_of_the_session_comes_back(spark):
    before = spark.conf.get(FREED)
    with pytest.raises(ValueError), freeing_shuffles(spark):
        with freeing_shuffles(spark):
            pass
        assert spark.conf.get(FREED) == "true"
        raise ValueError
    assert spark.conf.get(FREED) == before
    frame = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(frame.collect()) == sorted(frame.collect())


def test_stored_tables_are_packed_well(spark, tmp_path):
    table = FolderStore(spark, str(tmp_path)).save("silver.some", spark.range(10))
    assert all(file.endswith(".zstd.parquet") for file in table.inputFiles())
    assert table.count() == 10
