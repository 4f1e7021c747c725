"""Mergeable states of measures: what a summary table keeps so that coarser grains need no rows.

A count or a sum is its own state and is added up.  A mean is a sum and a count.  A
percentile is a KLL sketch: it keeps all values up to its size and beyond that answers
with a value whose rank is off by at most ``rank_error(k)`` of all values, with 99 %
confidence, however many sketches were merged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size of a percentile sketch: values kept whole, and about as many beyond.
SKETCH = 2000


def rank_error(k: int = SKETCH) -> float:
    """Published bound of a KLL sketch's rank error, as a share of all values."""
    return 2.296 / k**0.9021


@dataclass(frozen=True)
class State:
    """Stored columns, how each is merged, and the value made of the merged ones."""

    stored: Mapping[str, Column]
    merge: Mapping[str, Callable[[Column], Column]]
    value: Callable[[Callable[[str], Column]], Column]


def count(expression: Column) -> State:
    """A count of rows; no rows count zero."""
    return State({"n": expression}, {"n": F.sum}, lambda part: F.coalesce(part("n"), F.lit(0)))


def total(values: Column) -> State:
    """A sum; null without values."""
    return State({"sum": F.sum(values)}, {"sum": F.sum}, lambda part: part("sum"))


def mean(values: Column) -> State:
    """An average; null without values."""
    return State(
        {"sum": F.sum(values), "n": F.count(values)},
        {"sum": F.sum, "n": F.sum},
        lambda part: F.try_divide(part("sum"), part("n")),
    )


def quantile(values: Column, share: float, kind: str = "double", k: int = SKETCH) -> State:
    """A percentile of all values of type ``kind``; null without values."""
    return State(
        {"n": F.count(values), "sketch": F.kll_sketch_agg_double(values.cast("double"), F.lit(k))},
        {"n": F.sum, "sketch": F.kll_merge_agg_double},
        lambda part: F.when(
            part("n") > 0, F.kll_sketch_get_quantile_double(part("sketch"), F.lit(share)).cast(kind)
        ),
    )
