import pytest
from pyspark.errors import PySparkException

from flowlens.operators.expectations import audit, drop, enforce, fail
from flowlens.plans.pipeline import Pipeline
from flowlens.sources.readers import FrameSource


def test_drop_keeps_only_rows_that_hold(spark):
    frame = spark.createDataFrame([(1,), (None,), (-1,)], "id int")
    kept = enforce(frame, "t", [drop("positive", "id > 0")])
    assert [row.id for row in kept.collect()] == [1]


def test_fail_stops_the_query(spark):
    frame = spark.createDataFrame([(1,), (None,)], "id int")
    guarded = enforce(frame, "t", [fail("id_not_null", "id IS NOT NULL")])
    with pytest.raises(PySparkException, match="id_not_null violated in t"):
        guarded.collect()


def test_fail_lets_good_rows_through(spark):
    frame = spark.createDataFrame([(1,), (2,)], "id int")
    assert enforce(frame, "t", [fail("id_not_null", "id IS NOT NULL")]).count() == 2


def test_audit_counts_null_as_failed(spark):
    frame = spark.createDataFrame([(1,), (None,), (-1,)], "id int")
    rows = audit(frame, "t", [drop("positive", "id > 0"), fail("known", "id IS NOT NULL")])
    assert {row.expectation: (row.action, row.passed, row.failed) for row in rows.collect()} == {
        "positive": ("drop", 1, 2),
        "known": ("fail", 2, 1),
    }


@pytest.mark.parametrize(
    ("table", "source", "columns"),
    [
        ("project", "projects", "id long, key string"),
        ("user", "users", "account_id string"),
    ],
)
def test_key_tables_refuse_null_keys(spark, table, source, columns):
    frame = spark.createDataFrame([tuple(None for _ in columns.split(","))], columns)
    pipeline = Pipeline(FrameSource({source: frame}))
    with pytest.raises(PySparkException, match="not_null violated"):
        pipeline.silver(table).collect()


def test_fail_is_not_skipped_by_a_join_or_filter(spark, tmp_path):
    """A later filter or join key would drop the bad row in the scan, were it let through."""
    rows = [("a", "Ann"), (None, "Bob")]
    spark.createDataFrame(rows, "account_id string, display_name string").write.parquet(f"{tmp_path}/u")
    spark.createDataFrame([("a",)], "who string").write.parquet(f"{tmp_path}/w")
    users = enforce(
        spark.read.parquet(f"{tmp_path}/u"), "user", [fail("account_id_not_null", "account_id IS NOT NULL")]
    )
    logs = spark.read.parquet(f"{tmp_path}/w")
    for query in (
        users.where("account_id = 'a'"),
        users.where("account_id IS NOT NULL").select("display_name"),
        logs.join(users, logs.who == users.account_id),
        logs.join(users, logs.who == users.account_id, "left"),
    ):
        with pytest.raises(PySparkException, match="account_id_not_null violated in user"):
            query.collect()
