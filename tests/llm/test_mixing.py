"""Mixtures of tables with odd column names, and the number of their partitions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowlens.llm import common, mixing

DOCS = "doc_id long, text string, source string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def rows(spark):
    texts = [(i, f"text {i} " * (i % 7 + 1), "a" if i % 3 else "b") for i in range(300)]
    return spark.createDataFrame(texts + [(None, None, None)], DOCS)


def test_columns_may_have_any_name(spark):
    plain = rows(spark)
    names = ["__source", "__rate", "rate", "copies", "row", "shown", "content", "of_source", "point", "mass"]
    odd = plain
    for number, name in enumerate(names):
        odd = odd.withColumn(name, F.lit(number))
    mixed = mixing.mix(odd)
    assert mixed.columns == [*odd.columns, "mix_copy", "mix_order"]
    key = lambda row: (row.doc_id or -1, row.text or "", row.mix_copy, row.mix_order)
    found, want = mixed.collect(), mixing.mix(plain).collect()
    assert sorted(map(key, found)) == sorted(map(key, want)) and len(want) > 100
    assert all(row[name] == number for row in found for number, name in enumerate(names))


def test_partitions_follow_the_text(spark, monkeypatch):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert mixing.mix(rows(spark)).rdd.getNumPartitions() == least
    monkeypatch.setattr(mixing, "PART_CHARACTERS", 500)
    mixed = mixing.mix(rows(spark))
    assert mixed.rdd.getNumPartitions() > 3 * least
    order = [row.mix_order for row in mixed.collect()]
    assert order == sorted(order)


def test_no_documents(spark):
    assert mixing.mix(rows(spark).limit(0)).count() == 0
