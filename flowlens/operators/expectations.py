"""Row-level data expectations: stop the run, drop the row, or count both."""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

FAIL = "fail"
DROP = "drop"
# The count of all rows, beside those of the expectations.
ROWS = "rows"


@dataclass(frozen=True)
class Expectation:
    """A named SQL predicate that must be true; null counts as a violation."""

    name: str
    predicate: str
    action: str = DROP

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def fail(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, FAIL)


def drop(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, DROP)


def enforce(frame: DataFrame, table: str, expectations: Sequence[Expectation]) -> DataFrame:
    """Filter that keeps good rows; a row against a ``fail`` stops the query itself.

    The check sits in the plan, so it costs no extra pass and no driver action.
    Its predicate counts as non-deterministic, so the planner moves no filter of a
    later join or query below it: a bad row reaches the check before it is dropped.
    """
    for expectation in expectations:
        if expectation.action == FAIL:
            message = f"expectation {expectation.name} violated in {table}"
            passes = F.when(expectation.holds(), F.spark_partition_id() >= 0).otherwise(
                F.raise_error(message).cast("boolean")
            )
            frame = frame.where(passes)
        else:
            frame = frame.where(F.expr(expectation.predicate))
    return frame


class ExpectationViolated(ValueError):
    """Rows of a table break an expectation that must hold."""


@dataclass(frozen=True)
class HeavyKey:
    """A bound of how many rows with ``where`` have one value of ``column``.

    A frequent-items sketch of a fixed size is merged over all tasks.  It names the most
    frequent value with an estimate that is never too low, unless that value's share is
    below the sketch's error; then twice the error is the bound.
    """

    column: str
    where: str
    tracked: int = 10_000

    def sketch(self) -> Column:
        # All other rows are the value null, which may be the most frequent one.
        return F.expr(f"approx_top_k(CASE WHEN {self.where} THEN {self.column} END, 2, {self.tracked})")

    def bound(self, top: Sequence | None, rows: int) -> int:
        """From the sketch's answer over at most ``rows`` rows."""
        slots = 1 << (self.tracked * 4 // 3 - 1).bit_length()
        error = math.ceil(3.5 * rows / slots)
        return max([2 * error, *(entry["count"] for entry in top or () if entry["item"] is not None)])


class Watch:
    """Counts the rows that hold, as a side result of whatever reads the watched frame.

    The counts ride along with the write of the table, so there is no second pass.  They
    are taken where the rows are made, before any is dropped.  A task that is run again
    after its output was lost to a later stage may count its rows twice; a table whose
    write is its only stage counts each row once.
    """

    def __init__(self, table: str, expectations: Sequence[Expectation], heavy: Mapping[str, HeavyKey] | None = None):
        self.table, self.expectations, self.heavy = table, list(expectations), dict(heavy or {})
        self._seen = Observation(f"{table}-{uuid.uuid4().hex}")

    def over(self, frame: DataFrame) -> DataFrame:
        passed = [F.count_if(one.holds()).alias(one.name) for one in self.expectations]
        tops = [key.sketch().alias(name) for name, key in self.heavy.items()]
        return frame.observe(self._seen, F.count(F.lit(1)).alias(ROWS), *passed, *tops)

    def counts(self) -> dict[str, int]:
        """Rows, and rows that hold for each expectation, once the frame was read.

        Stops where an expectation that must hold does not, so that what was written is
        not committed.
        """
        seen = self._seen.get
        counts = {name: int(value) for name, value in seen.items() if name not in self.heavy}
        counts |= {name: key.bound(seen[name], counts[ROWS]) for name, key in self.heavy.items()}
        for one in self.expectations:
            if one.action == FAIL and counts[one.name] < counts[ROWS]:
                bad = counts[ROWS] - counts[one.name]
                raise ExpectationViolated(f"expectation {one.name} violated in {self.table} by {bad} rows")
        return counts


def audit_lines(table: str, expectations: Sequence[Expectation], counts: Mapping[str, int]) -> list[tuple]:
    """(table_name, expectation, action, passed, failed) from a table's counts."""
    return [
        (table, one.name, one.action, counts[one.name], counts[ROWS] - counts[one.name])
        for one in expectations
    ]


def require(frame: DataFrame, table: str, expectations: Sequence[Expectation]) -> DataFrame:
    """``enforce`` by one look ahead: a scan of the named columns checks all rows first.

    The frame then has no barrier, so filters of later queries reach its scan.
    """
    must = [one for one in expectations if one.action == FAIL]
    if must:
        found = frame.agg(F.count(F.lit(1)).alias(ROWS), *[F.count_if(one.holds()).alias(one.name) for one in must])
        counts = found.first().asDict()
        for one in must:
            if counts[one.name] < counts[ROWS]:
                bad = counts[ROWS] - counts[one.name]
                raise ExpectationViolated(f"expectation {one.name} violated in {table} by {bad} rows")
    for one in expectations:
        if one.action != FAIL:
            frame = frame.where(F.expr(one.predicate))
    return frame


def audit(frame: DataFrame, table: str, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation with its passed and failed counts, from one scan."""
    counts = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if(expectation.holds()).alias(f"passed_{position}")
            for position, expectation in enumerate(expectations)
        ],
    )
    lines = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(expectation.name).alias("expectation"),
            F.lit(expectation.action).alias("action"),
            F.col(f"passed_{position}").alias("passed"),
            (F.col("rows") - F.col(f"passed_{position}")).alias("failed"),
        )
        for position, expectation in enumerate(expectations)
    ]
    return counts.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
