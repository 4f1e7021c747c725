"""A corpus from raw documents to shards: five stages, each over all rows of the one before.

Every stage takes rows with nulls in any column, empty and very long texts, repeated rows,
and further columns of any name, and hands them on as they are; an empty table stays empty.
What a stage does with such rows is said in its docstring.  Each is written as Parquet before
the next reads it, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from flowlens.llm import decontam, mixing, sharding, simhash, toxicity
from flowlens.llm.common import shared_root, ship


# Rows of an Arrow batch in the stages: texts are long, and a worker holds a batch or two.
BATCH_ROWS = 2000


def _ready(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at one half or more go.

    Texts without words score like the bias, which is low where toxic labels are few; rows
    without doc_id are scored, but never learned from; without labels nothing goes.
    """
    _ready(spark)
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest doc_id.

    Repeated rows are near-duplicates, and so are all texts without words, null ones included; a row
    without doc_id stays only where no row of its group has one.
    """
    _ready(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none."""
    _ready(spark)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights, in a global random order.

    A null source is one of its own.  A document may get no copy, or several; columns called
    mix_copy and mix_order are replaced on the way and do not come back.
    """
    _ready(spark)
    return mixing.mix(docs).select(*[f"`{name}`" for name in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row: the last stage returns no text."""
    _ready(spark)
    return sharding.assign(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# A trained model, fingerprints and a CRC have no counterpart in SQL; tests hold
# the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written and read again by the next.

    Returns doc_id, size, text_crc32, shard and slot of every row that is left.
    """
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_root(spark)}/{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
