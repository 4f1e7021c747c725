"""The toxicity model: pairs that no weight can tell, recall on held-out labels, odd inputs."""

from __future__ import annotations

import random
import zlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import common, toxicity

FOLDER = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def test_pairs_are_learned_where_single_words_say_nothing():
    """Two words of one kind are toxic together, one of each kind is not."""
    draw = random.Random(1)
    kinds = [[f"in{i}x" for i in range(6)], [f"gr{i}y" for i in range(6)]]
    texts, labels = [], []
    for _ in range(2400):
        kind = draw.choice([0, 1, None, None])
        marked = draw.sample(kinds[kind], 2) if kind is not None else [draw.choice(words) for words in kinds]
        texts.append(" ".join(marked + [f"f{draw.randint(0, 39)}z" for _ in range(4)]))
        labels.append(float(kind is not None))
    rows, labels = toxicity.terms(texts), np.array(labels)
    model = toxicity.train(rows[:1600], labels[:1600])
    right = lambda m: ((m.scores(rows[1600:]) >= 0.5) == labels[1600:]).mean()
    assert right(model) > 0.97
    assert right(replace(model, factors=np.zeros_like(model.factors))) < 0.65


def test_held_out_recall_and_precision(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    scored = toxicity.score(docs, labels).where("held_out").join(labels, "doc_id")
    row = scored.selectExpr(
        "count_if(predicted = 1 and toxic = 1) as hit", "count_if(toxic = 1) as toxic", "count_if(predicted = 1) as said"
    ).first()
    assert row.hit >= 0.87 * row.toxic and row.hit >= 0.95 * row.said


def test_no_labels_one_kind_of_label_and_few_labels():
    rows = toxicity.terms(["a b c", "a b d", None, ""])
    assert (toxicity.train([], np.array([])).scores(rows) < 0.5).all()
    for labels in ([0.0] * 4, [1.0] * 4, [0.0, 1.0, 0.0, 1.0]):
        scores = toxicity.train(rows, np.array(labels)).scores(rows)
        assert np.isfinite(scores).all() and ((0 <= scores) & (scores <= 1)).all()


def test_empty_tables_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (3, "")], DOCS)
    docs = docs.withColumn("score", F.lit("x")).withColumn("__id", F.lit(1)).withColumn("__label", F.lit(1))
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (None, 1)], "doc_id long, toxic int")
    found = toxicity.score(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == 4
    held = {row.doc_id: row.held_out for row in found.collect()}
    assert held == {1: zlib.crc32(b"1") % 5 == 0, None: True, 3: zlib.crc32(b"3") % 5 == 0}
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert toxicity.score(docs.limit(0), labels).count() == 0
    assert toxicity.score(docs, labels.limit(0)).where("predicted = 1").count() == 0
