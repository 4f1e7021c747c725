"""Previous and next row per key without putting a hot key into one task.

A plain window sends every row of a key to a single task.  That is right for the
usual key, and one window is all it takes.  A key with more than ``most`` rows is
treated apart: equal rows are counted first, so no moment (or missing time) with
many repeats weighs more than one row.  What remains is cut into ranges of (key,
time, ties) by Spark's range partitioning, which balances them whatever the times
look like.  Neighbours inside a range come from a window over (key, range).  Only
the first and the last row of a range still miss one neighbour, and that neighbour
is itself a first or last row, so a second window over these edge rows closes the
gaps: it holds two rows per range, however many rows the key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of a key that one window task holds with ease.
MOST = 100_000


def with_neighbours(
    rows: DataFrame,
    key: str,
    time: str,
    ties: list[str],
    following: dict[str, str] | None = None,
    preceding: dict[str, str] | None = None,
    most: int = MOST,
    largest: int | None = None,
) -> DataFrame:
    """Add columns taken from the next and the previous row of the same ``key``.

    ``largest`` is a bound of the rows of one key, for instance from a sketch that was made
    while they were written.  Where it rules out hot keys, one scan and one window are all.

    ``following`` and ``preceding`` map new column names to the column read from
    the neighbour.  Rows are ordered by ``time`` and then by ``ties``; these and the
    key must be all their columns, so that rows equal in the order are equal.
    """
    following = following or {}
    preceding = preceding or {}
    order = [time, *ties]
    if sorted(rows.columns) != sorted([key, *order]):
        raise ValueError("rows must have the key, the time and the ties, and no other column")

    beside = Window.partitionBy(key).orderBy(*order)
    within = {
        **{new: F.lead(old).over(beside) for new, old in following.items()},
        **{new: F.lag(old).over(beside) for new, old in preceding.items()},
    }
    if largest is not None and largest <= most:
        return rows.withColumns(within)
    counts = rows.groupBy(F.col(key).alias("__hot")).agg(F.count(F.lit(1)).alias("__rows"))
    hot = counts.where(F.col("__rows") > most).select("__hot")
    is_hot = F.col(key).eqNullSafe(F.col("__hot"))
    cold = rows.join(hot, is_hot, "left_anti")
    found = cold.withColumns(within)
    return found.unionByName(
        _of_hot_keys(rows.join(hot, is_hot, "left_semi"), key, order, following, preceding)
    )


def _of_hot_keys(
    rows: DataFrame,
    key: str,
    order: list[str],
    following: dict[str, str],
    preceding: dict[str, str],
) -> DataFrame:
    equal = rows.groupBy(key, *order).agg(F.count(F.lit(1)).alias("__copies"))
    ranged = equal.repartitionByRange(key, *order).withColumn("__range", F.spark_partition_id())

    present = F.lit(True)
    inner = Window.partitionBy(key, "__range").orderBy(*order)
    ranged = ranged.withColumns(
        {
            "__has_next": F.lead(present).over(inner).isNotNull(),
            "__has_previous": F.lag(present).over(inner).isNotNull(),
            **{f"__next_{new}": F.lead(old).over(inner) for new, old in following.items()},
            **{f"__previous_{new}": F.lag(old).over(inner) for new, old in preceding.items()},
        }
    ).withColumn("__edge", ~(F.col("__has_next") & F.col("__has_previous")))

    # Rows between the edges keep their range, so they stay spread out.
    outer = Window.partitionBy(
        key, "__edge", F.when(~F.col("__edge"), F.col("__range"))
    ).orderBy(*order)

    def pick(has: str, near: str, far: Column) -> Column:
        return F.when(F.col(has), F.col(near)).otherwise(far)

    closed = ranged.select(
        key,
        *order,
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("__copy"),
        "__copies",
        *[
            pick("__has_next", f"__next_{new}", F.lead(old).over(outer)).alias(new)
            for new, old in following.items()
        ],
        *[
            pick("__has_previous", f"__previous_{new}", F.lag(old).over(outer)).alias(new)
            for new, old in preceding.items()
        ],
    )

    # Of equal rows, only the last sees the next row and only the first the one before.
    last, first = F.col("__copy") == F.col("__copies"), F.col("__copy") == 1
    return closed.select(
        key,
        *order,
        *[F.when(last, F.col(new)).otherwise(F.col(old)).alias(new) for new, old in following.items()],
        *[F.when(first, F.col(new)).otherwise(F.col(old)).alias(new) for new, old in preceding.items()],
    )
