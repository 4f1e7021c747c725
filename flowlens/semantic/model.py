"""Metric views: a fact table with named fields and measures, at any grain.

A view names scalar fields and aggregate measures once.  A query picks fields to
group by and measures to compute, and becomes one DataFrame: source, row filter,
only the joins the picked names need, conditions, aggregation, derived columns,
order and limit.  Measures are always aggregated from the view's own rows, never
from a coarser result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.semantic.states import State

SOURCE = "source"


class UnknownName(KeyError):
    """A name is neither a field or measure of the view nor a synonym of one."""


class AmbiguousName(KeyError):
    """A synonym stands for more than one field or measure."""


@dataclass(frozen=True)
class Field:
    """A scalar expression; ``join`` names the joined table it reads, if any."""

    name: str
    expression: Column
    join: str | None = None
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Measure:
    """An aggregate expression over the source rows, and its mergeable state if it has one."""

    name: str
    expression: Column
    synonyms: tuple[str, ...] = ()
    state: State | None = None


@dataclass(frozen=True)
class Join:
    """A left join that matches at most one row: ``key`` of the source, ``match`` of the table."""

    name: str
    table: str
    key: Column
    match: str


Names = Sequence[str] | Mapping[str, str]
Condition = Callable[[Callable[[str], Column]], Column]


def source(column: str) -> Column:
    return F.col(f"{SOURCE}.{column}")


def labelled(names: Names) -> dict[str, str]:
    return dict(names) if isinstance(names, Mapping) else {name: name for name in names}


@dataclass(frozen=True)
class MetricView:
    name: str
    table: str
    fields: tuple[Field, ...]
    measures: tuple[Measure, ...]
    joins: tuple[Join, ...] = ()
    condition: Column | None = None

    def field(self, name: str) -> Field:
        return _find(name, self.fields, self.name)

    def measure(self, name: str) -> Measure:
        return _find(name, self.measures, self.name)


def _find(name: str, entries: Iterable, view: str):
    entries = list(entries)
    wanted = name.casefold()
    exact = [entry for entry in entries if entry.name.casefold() == wanted]
    matches = exact or [
        entry for entry in entries if wanted in (synonym.casefold() for synonym in entry.synonyms)
    ]
    if not matches:
        raise UnknownName(f"{view} has no {name!r}")
    if len(matches) > 1:
        found = ", ".join(entry.name for entry in matches)
        raise AmbiguousName(f"{name!r} in {view} may be any of: {found}")
    return matches[0]


class _Fields:
    """Hands out field expressions and remembers which joins they need."""

    def __init__(self, view: MetricView):
        self.view = view
        self.joins: set[str] = set()

    def __call__(self, name: str) -> Column:
        field = self.view.field(name)
        if field.join:
            self.joins.add(field.join)
        return field.expression


@dataclass(frozen=True)
class BoundView:
    """A metric view over actual tables."""

    view: MetricView
    tables: Callable[[str], DataFrame]

    def _base(self, joins: set[str]) -> DataFrame:
        frame = self.tables(self.view.table).alias(SOURCE)
        if self.view.condition is not None:
            frame = frame.where(self.view.condition)
        for join in self.view.joins:
            if join.name in joins:
                other = self.tables(join.table).alias(join.name)
                frame = frame.join(other, join.key == F.col(f"{join.name}.{join.match}"), "left")
        return frame

    def rows(
        self,
        fields: Names,
        where: Condition | None = None,
        derived: Mapping[str, Condition] | None = None,
    ) -> DataFrame:
        """Fields and expressions over fields, one row per source row."""
        pick = _Fields(self.view)
        outputs = [pick(name).alias(label) for label, name in labelled(fields).items()]
        outputs += [build(pick).alias(label) for label, build in (derived or {}).items()]
        condition = where(pick) if where else None
        frame = self._base(pick.joins)
        if condition is not None:
            frame = frame.where(condition)
        return frame.select(*outputs)

    def query(
        self,
        fields: Names = (),
        measures: Names = (),
        *,
        where: Condition | None = None,
        grouped_by: Sequence[str] = (),
        adhoc: Mapping[str, Condition] | None = None,
        flags: Mapping[str, Condition] | None = None,
        derived: Mapping[str, Condition] | None = None,
        having: Condition | None = None,
        order_by: Sequence[str] = (),
        limit: int | None = None,
    ) -> DataFrame:
        """Measures per combination of fields; without fields one row for all.

        ``grouped_by`` names further fields to group and order by that are not
        returned.  ``adhoc`` aggregates fields on the spot.  ``flags`` are conditions
        over fields to group by as well, under their own labels.  ``derived`` and
        ``having`` compute over the grouped fields and over measures, which are
        added to the aggregation when they are not returned.  ``order_by`` takes
        output labels or grouped fields, a leading ``-`` meaning descending,
        nulls last both ways.
        """
        pick = _Fields(self.view)
        group_labels = labelled(fields)
        measure_labels = labelled(measures)
        keys: dict[str, tuple[str, Column]] = {}
        for name in [*group_labels.values(), *grouped_by]:
            canonical = self.view.field(name).name
            keys.setdefault(canonical, (f"__key_{len(keys)}", pick(name)))
        marks = {label: (f"__flag_{n}", build(pick)) for n, (label, build) in enumerate((flags or {}).items())}
        totals: dict[str, tuple[str, Column]] = {}

        def total(name: str) -> Column:
            measure = self.view.measure(name)
            totals.setdefault(measure.name, (f"__total_{len(totals)}", measure.expression))
            return F.col(totals[measure.name][0])

        def grouped(name: str) -> Column | None:
            try:
                canonical = self.view.field(name).name
            except UnknownName:
                return None
            return F.col(keys[canonical][0]) if canonical in keys else None

        def value(name: str) -> Column:
            key = grouped(name)
            return total(name) if key is None else key

        outputs = {label: value(name) for label, name in group_labels.items()}
        outputs |= {label: F.col(mark) for label, (mark, _) in marks.items()}
        outputs |= {label: total(name) for label, name in measure_labels.items()}
        extra = {label: build(pick) for label, build in (adhoc or {}).items()}
        outputs |= {label: F.col(f"__adhoc_{position}") for position, label in enumerate(extra)}
        outputs |= {label: build(value) for label, build in (derived or {}).items()}
        kept = having(value) if having else None
        condition = where(pick) if where else None
        sort_keys = []
        for name in order_by:
            label = name.removeprefix("-")
            column = outputs[label] if label in outputs else value(label)
            sort_keys.append(
                column.desc_nulls_last() if name.startswith("-") else column.asc_nulls_last()
            )

        frame = self._base(pick.joins)
        if condition is not None:
            frame = frame.where(condition)
        grouping = [*keys.values(), *marks.values()]
        aggregated = frame.groupBy(*[column.alias(label) for label, column in grouping]).agg(
            *[column.alias(label) for label, column in totals.values()],
            *[column.alias(f"__adhoc_{position}") for position, column in enumerate(extra.values())],
        )
        if kept is not None:
            aggregated = aggregated.where(kept)
        if sort_keys:
            aggregated = aggregated.orderBy(*sort_keys)
        if limit is not None:
            aggregated = aggregated.limit(limit)
        return aggregated.select(*[column.alias(label) for label, column in outputs.items()])
