"""Time arithmetic and bucketing as native column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket labels and their upper bounds in days (exclusive).
AGE_BUCKETS = ((7, "0-7d"), (14, "7-14d"), (30, "14-30d"), (90, "30-90d"))
CYCLE_BUCKETS = (
    (1, "< 1d"),
    (3, "1-3d"),
    (7, "3-7d"),
    (14, "7-14d"),
    (30, "14-30d"),
    (60, "30-60d"),
    (90, "60-90d"),
)
OPEN_ENDED_BUCKET = "90d+"


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days between two timestamps, truncated toward zero."""
    return F.timestamp_diff("DAY", start, end)


def hours(seconds: Column) -> Column:
    """Seconds as exact decimal hours with six digits, so sums do not depend on order."""
    return seconds / F.lit(Decimal("3600.0"))


def bucket(days: Column, bounds: tuple[tuple[int, str], ...]) -> Column:
    """Label of the first bound above ``days``; anything else, null too, is open ended."""
    (first_bound, first_label), *rest = bounds
    labelled = F.when(days < first_bound, first_label)
    for bound, label in rest:
        labelled = labelled.when(days < bound, label)
    return labelled.otherwise(OPEN_ENDED_BUCKET)


def percentile(values: Column, share: float) -> Column:
    """Mergeable percentile sketch: partial aggregates, no group is collected."""
    return F.percentile_approx(values, share, 10000)
