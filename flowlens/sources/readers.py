"""Where raw tables come from and where built tables go."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from flowlens.config import BRONZE_ALIASES, LayerConfig


@dataclass(frozen=True)
class CatalogSource:
    """Raw tables of a catalog schema."""

    spark: SparkSession
    config: LayerConfig

    def table(self, name: str) -> DataFrame:
        return self.spark.read.table(self.config.table_name("bronze", name))


@dataclass(frozen=True)
class FileSource:
    """Raw tables as one folder or file per table, in any format Spark reads."""

    spark: SparkSession
    root: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    suffix: str = ""

    def table(self, name: str) -> DataFrame:
        path = f"{self.root}/{BRONZE_ALIASES.get(name, name)}{self.suffix}"
        return self.spark.read.format(self.format).options(**self.options).load(path)


@dataclass(frozen=True)
class FrameSource:
    """Raw tables given as DataFrames or as functions that make them."""

    frames: Mapping[str, DataFrame | Callable[[], DataFrame]]

    def table(self, name: str) -> DataFrame:
        frame = self.frames[name]
        return frame() if callable(frame) else frame
