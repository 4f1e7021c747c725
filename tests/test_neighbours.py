import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlens.functions.neighbours import with_neighbours

START = datetime(2020, 1, 1)


def brute_force(rows):
    """(key, time, value, next time, previous value) for every row."""
    found = []
    for key in {row[0] for row in rows}:
        own = sorted((time, value) for k, time, value in rows if k == key)
        for place, (time, value) in enumerate(own):
            following = own[place + 1][0] if place + 1 < len(own) else None
            preceding = own[place - 1][1] if place else None
            found.append((key, time, value, following, preceding))
    return found


def by_spark(spark, rows, most=100_000):
    frame = spark.createDataFrame(rows, "key string, time timestamp, value string")
    result = with_neighbours(
        frame, "key", "time", ["value"], {"following": "time"}, {"preceding": "value"}, most
    )
    return [tuple(row) for row in result.collect()]


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("most", [0, 100, 100_000])
def test_one_key_with_most_rows(spark, most):
    dice = random.Random(3)
    rows = [
        (
            "hot" if dice.random() < 0.7 else f"k{dice.randrange(40)}",
            START + timedelta(minutes=dice.randrange(20000)),
            str(dice.randrange(4)),
        )
        for _ in range(3000)
    ]
    assert ordered(by_spark(spark, rows, most)) == ordered(brute_force(rows))


@pytest.mark.parametrize("most", [0, 4, 100_000])
def test_equal_rows_and_single_rows(spark, most):
    rows = [("a", START, "1")] * 5 + [("a", START + timedelta(hours=3), "1")] * 4
    rows += [("b", START, "9")]
    assert ordered(by_spark(spark, rows, most)) == ordered(brute_force(rows))


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(0, 400), st.sampled_from("xy")),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([0, 5, 100_000]),
)
def test_any_history(spark, drawn, most):
    rows = [(key, START + timedelta(minutes=minutes), value) for key, minutes, value in drawn]
    assert ordered(by_spark(spark, rows, most)) == ordered(brute_force(rows))


def windows_agree(spark, frame, most):
    """The result with a low limit equals that of one plain window."""
    names = {"following": {"next": "time"}, "preceding": {"before": "value"}}
    split = with_neighbours(frame, "key", "time", ["value"], **names, most=most)
    plain = with_neighbours(frame, "key", "time", ["value"], **names)
    return split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_a_hot_hour_is_split(spark):
    """All changes of one issue within one hour: no task holds more than a part of them."""
    moments = F.timestamp_micros(F.lit(1_577_836_800_000_000) + F.col("id") * 17_000)
    frame = spark.range(0, 20_000, 1, 4).select(
        F.lit("hot").alias("key"), moments.alias("time"), (F.col("id") % 4).cast("string").alias("value")
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = with_neighbours(frame, "key", "time", ["value"], {"next": "time"}, most=1000)
        tasks = [row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 20_000 and max(tasks) <= 20_000 / 2
        assert windows_agree(spark, frame, 1000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_a_hot_key_without_times(spark):
    frame = spark.range(0, 20_000, 1, 4).select(
        F.lit("hot").alias("key"),
        F.lit(None).cast("timestamp").alias("time"),
        (F.col("id") % 3).cast("string").alias("value"),
    )
    assert windows_agree(spark, frame, 1000)


def test_other_columns_are_refused(spark):
    frame = spark.createDataFrame([("a", START, "1", 2)], "key string, time timestamp, value string, more int")
    with pytest.raises(ValueError):
        with_neighbours(frame, "key", "time", ["value"], {"following": "time"})
