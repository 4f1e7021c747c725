"""Contamination that only part of an item, a short item or an answer gives away."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from flowlens.llm import common, decontam

DOCS = "doc_id long, text string"
FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def found(spark, docs, items, schema="item_id long, text string", **options):
    result = decontam.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, schema), **options)
    assert [name for name, _ in result.dtypes] == ["doc_id", "item_id", "score", "overlap", "question", "answer"]
    return sorted((row.doc_id, row.item_id) for row in result.collect())


def test_beginnings_of_items_are_found(spark):
    """Texts that hold an item but its last words, up to an overlap of 0.8."""
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    docs, wanted = [], []
    rng = random.Random(1)
    for row in items.collect():
        words = decontam.words_of(row.text)
        whole = decontam.shingles(words)
        for count in range(len(words), 4, -1):
            if len(decontam.shingles(words[:count])) < 0.8 * len(whole):
                break
        kept = words[: count + 1]
        docs.append((row.item_id, " ".join([f"x{rng.random()}" for _ in range(30)] + kept)))
        own = set(decontam.shingles(kept))
        if sum(s in own for s in whole) >= 0.8 * len(whole):
            wanted.append(row.item_id)
    hits = decontam.contaminated(spark.createDataFrame(docs, DOCS), items).where("doc_id = item_id")
    assert sorted(row.item_id for row in hits.collect()) == sorted(wanted) and len(wanted) == 200
    assert decontam.clean(spark.createDataFrame(docs, DOCS), items).count() == 0


def test_short_items_are_found_as_they_are(spark):
    items = [(1, "What is seven?"), (2, "a b c d"), (3, ""), (4, None), (5, "the quick brown fox jumps over")]
    docs = [(1, "what is seven"), (2, "x. What, is SEVEN! y"), (3, "what is it seven"), (4, "d a b c d"), (5, None), (6, "")]
    assert found(spark, docs, items) == [(1, 1), (2, 1), (4, 2)]
    # Short items alone make no index.
    assert found(spark, docs, items[:2]) == [(1, 1), (2, 1), (4, 2)]


def test_an_answer_column_must_be_held_too(spark):
    question = "which of the following planets is the largest one that goes around our own sun"
    answer = "it is the giant planet that bears the name of the first of all gods"
    schema = "item_id long, text string, answer string"
    items = [(1, question, answer), (2, question, None), (3, "who sings", "nobody")]
    docs = [(1, f"{question} {answer}"), (2, question), (3, answer), (4, "who sings nobody"), (5, "who sings")]
    assert found(spark, docs, items, schema) == [(1, 1), (1, 2), (2, 2), (4, 3)]
    frame = spark.createDataFrame(items, schema)
    rows = decontam.contaminated(spark.createDataFrame(docs[:1], DOCS), frame).orderBy("item_id").collect()
    assert rows[0].answer == rows[0].question == 1.0 and rows[1].answer is None


def test_slices_one_after_the_other_find_the_same(spark):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = lambda frame: sorted(map(tuple, frame.collect()))
    whole = rows(decontam.contaminated(docs, items))
    assert len(whole) > 2
    assert rows(decontam.contaminated(docs, items, slice_bytes=3000)) == whole
    assert rows(decontam.clean(docs, items, slice_bytes=3000)) == rows(decontam.clean(docs, items))


def test_repeated_rows_clashing_columns_and_empty_tables(spark):
    text = "one two three four five six seven eight"
    items = spark.createDataFrame([(1, text, 0.5), (1, text, 0.5)], "item_id long, text string, score double")
    docs = spark.createDataFrame([(7, text, 1, 2)] * 2 + [(8, "clean", 1, 2)], DOCS + ", hit int, item_id int")
    assert decontam.contaminated(docs, items).count() == 4
    kept = decontam.clean(docs, items)
    assert kept.columns == docs.columns and [row.doc_id for row in kept.collect()] == [8]
    assert decontam.contaminated(docs.limit(0), items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0
    assert decontam.clean(docs, items.limit(0)).count() == 3
    null = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert [row.doc_id for row in decontam.contaminated(null, items).collect()] == [None] * 4
