"""The corpus pipeline against the same stages by hand."""

from __future__ import annotations

import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[2])
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

import pytest  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_each_stage_works_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, docs, FOLDER)
        assert frame.columns == columns
        frame.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "mixing":
            assert docs.count() <= kept and docs.count() == docs.select("doc_id").distinct().count()
            kept = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    key = lambda row: (row.doc_id, row.size, row.text_crc32)
    assert sorted(map(key, last)) == sorted(map(key, whole)) and len(whole) == docs.count()


@pytest.fixture
def odd_folder(spark, tmp_path):
    """A small corpus with every kind of odd row, and columns named like the operators' own."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    odd = [(None, None), (None, ""), (7, None), (7, ""), (1, " \n\t "), (None, "one two three four five six")] * 2
    odd += [(10_000 + i, "long " * 30_000 + str(i // 2)) for i in range(4)]
    rows = [(doc, text, None, None, None) for doc, text in odd]
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    for name in ("key", "row", "rate", "score", "hit", "shard", "slot", "__kept", "__source", "doubt", "of_source"):
        docs = docs.withColumn(name, F.lit(name))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    labels.unionByName(labels).unionByName(spark.createDataFrame([(None, None, None)], labels.schema)).write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    odd_items = spark.createDataFrame([(None, None), (1, ""), (2, "no such words")], items.schema)
    items.unionByName(odd_items).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_take_odd_rows_and_names(spark, odd_folder):
    docs = spark.read.parquet(f"{odd_folder}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, odd_folder)
        assert kept.columns == columns
        kept.write.parquet(f"{odd_folder}/{name}")
        docs = spark.read.parquet(f"{odd_folder}/{name}")
        assert docs.where("key <> 'key' or doubt <> 'doubt' or __kept <> '__kept'").isEmpty()
        if name == "near_dedup":
            texts = [row.text or "" for row in docs.collect()]
            assert sum(not text.split() for text in texts) == 1
            # Two different endings, each twice: their sets have one shingle of three in common.
            assert sum(text.startswith("long ") for text in texts) == 2
            assert docs.count() < rows
    last = corpus_pipeline.STAGES[-1][1](spark, docs, odd_folder)
    assert last.count() == docs.count()


def test_an_empty_corpus_stays_empty(spark, odd_folder, tmp_path):
    docs = spark.read.parquet(f"{odd_folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, odd_folder)
        docs.write.parquet(f"{tmp_path}/empty/{name}")
        docs = spark.read.parquet(f"{tmp_path}/empty/{name}")
        assert docs.count() == 0
