"""Column resolution: one target column, several spellings in the source."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MissingColumn(ValueError):
    """A source table lacks a column that has no substitute."""


@dataclass(frozen=True)
class Target:
    """A typed output column and the source names that may provide it, best first."""

    name: str
    type: str
    sources: tuple[str, ...]
    default: object = None
    required: bool = False


def present_name(columns: Iterable[str], names: Iterable[str]) -> str | None:
    known = set(columns)
    return next((name for name in names if name in known), None)


def resolve(columns: Iterable[str], target: Target) -> Column:
    """Cast expression for a target: the first present source, else the default."""
    found = present_name(columns, target.sources)
    if found is None and target.required:
        raise MissingColumn(f"{target.name}: none of {', '.join(target.sources)} present")
    value = F.lit(target.default) if found is None else F.col(f"`{found}`")
    return value.cast(target.type).alias(target.name)


def project(source: DataFrame, targets: Iterable[Target]) -> DataFrame:
    columns = source.columns
    return source.select(*[resolve(columns, target) for target in targets])
