"""Builds that become visible at once, and counts that come with the write."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowlens.config import LayerConfig
from flowlens.operators.expectations import ExpectationViolated, Watch, drop, fail
from flowlens.plans.pipeline import GOLD, SILVER, Pipeline
from flowlens.sources.readers import FrameSource
from flowlens.sources.sample import LANDED, SAMPLE_AS_OF, SampleSource
from flowlens.sources.sinks import CatalogStore, FolderStore
from flowlens.sources.snapshots import Catalogue, NoSuchTable, SnapshotSource

SMALL = "/root/testdata/sf0.001"
PRIORITY = "id int, name string"


def priorities(spark, *rows):
    return FrameSource({"priority": spark.createDataFrame(list(rows), PRIORITY)})


def saved(spark, root, source, name="silver.priority"):
    store = FolderStore(spark, str(root))
    pipeline = Pipeline(source, store=store)
    pipeline.table(name)
    return store


def shown(source, name="silver.priority"):
    return sorted((row[0], row[1]) for row in source.table(name).collect())


def test_what_is_saved_is_seen_after_the_commit(spark, tmp_path):
    store = saved(spark, tmp_path, priorities(spark, (1, "High")))
    with pytest.raises(NoSuchTable):
        SnapshotSource(spark, str(tmp_path)).table("silver.priority")
    store.commit()
    assert shown(SnapshotSource(spark, str(tmp_path))) == [(1, "High")]


def test_a_reader_keeps_its_version(spark, tmp_path):
    saved(spark, tmp_path, priorities(spark, (1, "High"))).commit()
    before = SnapshotSource(spark, str(tmp_path))
    frame = before.table("silver.priority")
    saved(spark, tmp_path, priorities(spark, (2, "Low"))).commit()
    assert shown(before) == [(1, "High")] and frame.count() == 1
    assert shown(SnapshotSource(spark, str(tmp_path))) == [(2, "Low")]
    assert shown(SnapshotSource(spark, str(tmp_path), before.snapshot.name)) == [(1, "High")]


def test_a_build_that_fails_midway_leaves_the_old_rows(spark, tmp_path):
    """Two tables of the second build are written, the third breaks."""
    root = str(tmp_path)
    raw = SampleSource(spark, SMALL)
    first = Pipeline(raw, LayerConfig(as_of=SAMPLE_AS_OF), FolderStore(spark, root), landed=LANDED)
    raw.issues = lambda: first.bronze("issues")
    first.build()
    old = SnapshotSource(spark, root)
    assert len([name for name in old.snapshot.tables if not name.startswith("bronze")]) == len(SILVER) + len(GOLD)
    rows = {name: old.table(name).count() for name in ("silver.priority", "silver.user", "gold.fct_issue")}

    broken = priorities(spark, (9, "New"))
    broken.frames["resolution"] = None
    broken.frames["users"] = spark.createDataFrame([(None,)], "account_id string")
    store = FolderStore(spark, root)
    second = Pipeline(broken, store=store)
    assert second.silver("priority").count() == 1
    with pytest.raises((PySparkException, ExpectationViolated), match="account_id_not_null"):
        second.silver("user")
    now = SnapshotSource(spark, root)
    assert now.snapshot.name == old.snapshot.name
    assert {name: now.table(name).count() for name in rows} == rows


def test_expire_deletes_what_no_kept_snapshot_names(spark, tmp_path):
    for number in range(4):
        saved(spark, tmp_path, priorities(spark, (number, "x"))).commit()
    saved(spark, tmp_path, priorities(spark, (99, "never committed")))
    catalogue = Catalogue(spark, str(tmp_path))
    names = catalogue.history()
    assert len(names) == 4
    assert len(catalogue.expire(keep=2)) == 3
    assert catalogue.history() == names[-2:]
    assert shown(SnapshotSource(spark, str(tmp_path), names[-2])) == [(2, "x")]
    assert shown(SnapshotSource(spark, str(tmp_path))) == [(3, "x")]
    with pytest.raises(ValueError, match="must be kept"):
        catalogue.expire(keep=0)


def test_empty_store_and_empty_table(spark, tmp_path):
    assert Catalogue(spark, str(tmp_path / "none")).current().tables == {}
    store = saved(spark, tmp_path, priorities(spark))
    assert store.counts("silver.priority")["rows"] == 0
    store.commit()
    assert shown(SnapshotSource(spark, str(tmp_path))) == []


def test_a_failed_catalog_write_leaves_the_old_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS silver_s")
    config = LayerConfig(silver_schema="silver_s")
    store = CatalogStore(spark, config)
    Pipeline(priorities(spark, (1, "High"), (None, "Lost")), config, store).silver("priority")
    counts = store.counts("silver.priority")
    assert counts["rows"] == 2 and 1 in counts.values()
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("string").alias("id"))
    with pytest.raises(PySparkException, match="lost"):
        store.save("silver.priority", broken)
    assert spark.table("silver_s.priority").count() == 1
    assert [row.tableName for row in spark.sql("SHOW TABLES IN silver_s").where("not isTemporary").collect()] == [
        "priority"
    ]


def test_audit_comes_from_the_build(spark, tmp_path):
    """Same counts as a scan of every table, and no job of its own."""
    raw = SampleSource(spark, SMALL)
    config = LayerConfig(as_of=SAMPLE_AS_OF)
    built = Pipeline(raw, config, FolderStore(spark, str(tmp_path)), landed=LANDED)
    raw.issues = lambda: built.bronze("issues")
    built.build()
    scanned = Pipeline(raw, config)
    key = lambda row: tuple(row)
    want = sorted(map(key, scanned.audit().collect()))

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("audit", "audit")
    try:
        found = sorted(map(key, built.audit().collect()))
        jobs = list(tracker.getJobIdsForGroup("audit"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert found == want and len(found) == 23
    assert jobs == []
    # Another application reads the counts from the snapshot.
    later = Pipeline(raw, config, FolderStore(spark, str(tmp_path)))
    assert later.store.counts("silver.issue_link") == built.store.counts("silver.issue_link")


def test_watch_counts_what_is_dropped(spark):
    frame = spark.createDataFrame([(1,), (None,), (-1,)], "id int")
    watch = Watch("t", [drop("positive", "id > 0"), drop("known", "id IS NOT NULL")])
    assert watch.over(frame).where("id > 0").count() == 1
    assert watch.counts() == {"rows": 3, "positive": 1, "known": 2}


def test_watch_refuses_to_give_counts_of_a_broken_table(spark):
    frame = spark.createDataFrame([(1,), (None,)], "id int")
    watch = Watch("t", [fail("known", "id IS NOT NULL")])
    watch.over(frame).count()
    with pytest.raises(ExpectationViolated, match="known violated in t by 1 rows"):
        watch.counts()


def pushed(frame):
    return frame._jdf.queryExecution().executedPlan().toString().split("PushedFilters:")[1].split("]")[0]


def test_filters_on_a_checked_table_reach_the_scan(spark, tmp_path):
    """From the stored copy, and without a store where the check looks ahead."""
    path = str(tmp_path / "users")
    spark.createDataFrame([("a", "Ann"), ("b", "Bob")], "account_id string, display_name string").write.parquet(path)
    source = FrameSource({"users": lambda: spark.read.parquet(path)})
    barrier = Pipeline(source).silver("user").where("display_name = 'Ann'")
    assert "EqualTo" not in pushed(barrier)
    for pipeline in (Pipeline(source, store=FolderStore(spark, str(tmp_path / "s"))), Pipeline(source, check_ahead=True)):
        chosen = pipeline.silver("user").where("display_name = 'Ann'")
        assert chosen.count() == 1 and "EqualTo" in pushed(chosen)


def test_a_look_ahead_stops_on_bad_rows(spark, tmp_path):
    path = str(tmp_path / "users")
    spark.createDataFrame([("a",), (None,)], "account_id string").write.parquet(path)
    source = FrameSource({"users": lambda: spark.read.parquet(path)})
    with pytest.raises(ExpectationViolated, match="account_id_not_null violated in user by 1 rows"):
        Pipeline(source, check_ahead=True).silver("user")
    with pytest.raises((PySparkException, ExpectationViolated), match="account_id_not_null violated"):
        Pipeline(source, store=FolderStore(spark, str(tmp_path / "s"))).silver("user")
