from types import SimpleNamespace

import pytest

from flowlens.session import (
    configure,
    folder_bytes,
    remove_folder,
    shared_folder,
    starting_partitions,
)

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_partitions_grow_with_the_input():
    assert starting_partitions(0) == 0
    assert starting_partitions(1024**2) == 1
    assert starting_partitions(1024**4) == 21846
    assert starting_partitions(100 * 1024**4) == 100 * 1024**4 // (48 * 1024**2) + 1


def test_only_large_inputs_raise_the_number(spark):
    configure(spark, 10 * 1024**2)
    assert spark.conf.get(INITIAL, None) is None
    try:
        configure(spark, 1024**3)
        assert spark.conf.get(INITIAL) == "22"
    finally:
        spark.conf.unset(INITIAL)


def test_a_task_reads_a_bounded_part_of_a_file(spark, tmp_path):
    configure(spark)
    rows = spark.range(0, 10_000_000, 1, 1).selectExpr("rand(1) as value")
    rows.write.option("parquet.block.size", str(4 * 1024**2)).parquet(str(tmp_path / "large"))
    size = folder_bytes(spark, str(tmp_path / "large"))
    assert size > 72 * 1024**2
    parts = spark.read.parquet(str(tmp_path / "large")).rdd.getNumPartitions()
    assert parts >= size / (16 * 1024**2)


def test_folder_size(spark, tmp_path):
    (tmp_path / "inner").mkdir()
    (tmp_path / "inner" / "file").write_bytes(b"x" * 1000)
    assert folder_bytes(spark, str(tmp_path)) == 1000


def test_shared_folder_is_the_one_the_cluster_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(unset)


def test_removed_folder_is_gone(spark, tmp_path):
    (tmp_path / "inner").mkdir()
    remove_folder(spark, str(tmp_path / "inner"))
    assert not (tmp_path / "inner").exists()
