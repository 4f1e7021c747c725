"""Joins of the SimHash grids: their rows are many times what Spark's planner thinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.llm import simhash
from flowlens.llm.common import land, ship


def broadcasts(frame):
    frame.collect()
    return "BroadcastExchange" in frame._jdf.queryExecution().executedPlan().toString()


def fingerprints(spark):
    """Four thousand fingerprints in pairs that differ in one bit, as landed tables are small."""
    return spark.range(4000).select(F.xxhash64(F.col("id") - F.col("id") % 2).bitwiseXOR(F.col("id") % 2).alias("fp"))


def test_grid_rows_are_not_sent_to_the_driver(spark, tmp_path):
    fingerprints(spark).write.parquet(f"{tmp_path}/fp")
    read = spark.read.parquet(f"{tmp_path}/fp")
    links = simhash.star_links(read)
    assert not broadcasts(links)
    assert links.distinct().count() == 2000
    rooted = read.select("fp", F.col("fp").alias("root"))
    met = simhash.meeting_roots(rooted)
    assert not broadcasts(met)
    assert met.count() == 2000


def test_near_pairs_come_without_a_broadcast(spark, tmp_path):
    fingerprints(spark).write.parquet(f"{tmp_path}/fp")
    pairs = simhash.near_links(spark.read.parquet(f"{tmp_path}/fp"))
    assert not broadcasts(pairs)
    assert pairs.count() == 2000


def test_near_dedup_sends_no_grid_rows_to_the_driver(spark, monkeypatch):
    ship(spark)
    plans = {}

    def landed(frame, name):
        plans[name] = frame._jdf.queryExecution().sparkPlan().toString()
        return land(frame, name)

    monkeypatch.setattr(simhash, "land", landed)
    docs = spark.createDataFrame([(f"word{n} and other{n} words of text {n}",) for n in range(50)], "text string")
    assert simhash.near_texts(docs).count() == 0
    assert {"stars", "meetings"} <= set(plans)
    assert not [name for name in ("stars", "meetings") if "BroadcastHashJoin" in plans[name]]
