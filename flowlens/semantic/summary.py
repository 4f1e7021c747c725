"""Summaries of metric views: stored states at one grain, from which coarser ones are merged."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.semantic.model import BoundView, Condition, Names, UnknownName, labelled
from flowlens.semantic.states import State


@dataclass(frozen=True)
class Summary:
    """Which view is summed up, by which fields, and which further flags and measures it keeps.

    All measures of the view that have a state are kept.  ``flags`` are conditions over the
    view's fields that become fields of the summary; ``further`` are states over them.
    """

    name: str
    view: str
    grain: tuple[str, ...]
    flags: Mapping[str, Condition] = field(default_factory=dict)
    further: Mapping[str, Callable[[Callable[[str], Column]], State]] = field(default_factory=dict)


class UnknownGrain(UnknownName):
    """A summary does not keep that field or measure."""


class BoundSummary:
    """A summary of a bound view; ``stored`` are its rows once they are written."""

    def __init__(self, spec: Summary, view: BoundView, stored: Callable[[], DataFrame]):
        self.spec, self.bound, self._stored = spec, view, stored
        self._keys = [*(view.view.field(name).name for name in spec.grain), *spec.flags]
        self._states = {one.name: one.state for one in view.view.measures if one.state}

        def no_field(name: str) -> Column:
            return view.view.field(name).expression

        self._states |= {name: build(no_field) for name, build in spec.further.items()}
        self._parts = {
            (name, part): f"state_{number}"
            for number, (name, part) in enumerate(
                (name, part) for name, state in self._states.items() for part in state.stored
            )
        }

    def build(self) -> DataFrame:
        """The states per grain, from one aggregation of the view's rows."""
        states = {
            label: (lambda f, name=name, part=part: self._states[name].stored[part])
            for (name, part), label in self._parts.items()
        }
        return self.bound.query(
            {f"key_{number}": name for number, name in enumerate(self.spec.grain)},
            adhoc=states,
            flags={f"key_{len(self.spec.grain) + n}": flag for n, flag in enumerate(self.spec.flags.values())},
        )

    def rows(self) -> DataFrame:
        """The stored states."""
        return self._stored()

    def _key(self, name: str) -> Column:
        if name in self.spec.flags:
            canonical = name
        else:
            canonical = self.bound.view.field(name).name
        if canonical not in self._keys:
            raise UnknownGrain(f"{self.spec.name} is not kept by {name!r}")
        return F.col(f"key_{self._keys.index(canonical)}")

    def _state(self, name: str) -> tuple[str, State]:
        canonical = name if name in self.spec.further else self.bound.view.measure(name).name
        if canonical not in self._states:
            raise UnknownGrain(f"{self.spec.name} has no mergeable state of {name!r}")
        return canonical, self._states[canonical]

    def query(
        self,
        fields: Names = (),
        measures: Names = (),
        *,
        where: Condition | None = None,
        derived: Mapping[str, Condition] | None = None,
        order_by: Sequence[str] = (),
    ) -> DataFrame:
        """Measures per combination of kept fields, merged from the stored states.

        Takes the names that the view takes.  A field, condition or measure that the summary
        does not keep is refused, never approximated.
        """
        keys = {label: self._key(name) for label, name in labelled(fields).items()}
        merged: dict[str, Column] = {}

        def value(name: str) -> Column:
            canonical, state = self._state(name)
            for part in state.stored:
                label = self._parts[canonical, part]
                merged[label] = state.merge[part](F.col(label)).alias(label)
            return state.value(lambda part: F.col(self._parts[canonical, part]))

        outputs = {label: F.col(f"`{label}`") for label in keys}
        outputs |= {label: value(name) for label, name in labelled(measures).items()}
        outputs |= {label: build(value) for label, build in (derived or {}).items()}
        frame = self._stored()
        if where is not None:
            frame = frame.where(where(self._key))
        grouped = [key.alias(label) for label, key in keys.items()]
        frame = frame.groupBy(*grouped).agg(*merged.values()) if merged else frame.select(*grouped).distinct()
        frame = frame.select(*[column.alias(label) for label, column in outputs.items()])
        if order_by:
            frame = frame.orderBy(
                *[
                    F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_last()
                    for name in order_by
                ]
            )
        return frame
