"""Comparison of two Arrow tables regardless of row order."""

from __future__ import annotations

import math

import pyarrow as pa

_SAME_KIND = {"large_string": "string", "string_view": "string"}


def kind(arrow_type: pa.DataType) -> str:
    name = str(arrow_type)
    if name.startswith("timestamp"):
        return "timestamp"
    return _SAME_KIND.get(name, name)


def shown(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        if not math.isfinite(value):
            return str(value)
        return str(int(value)) if value == int(value) else f"{value:.9g}"
    if getattr(value, "tzinfo", None) is not None:
        value = value.replace(tzinfo=None)
    return str(value)


def lines(table: pa.Table) -> list[tuple[str, ...]]:
    columns = [table.column(name).to_pylist() for name in sorted(table.column_names)]
    return sorted(tuple(shown(value) for value in row) for row in zip(*columns, strict=True))


def differences(ours: pa.Table, theirs: pa.Table) -> list[str]:
    """What sets two results apart; empty when they are the same."""
    kinds = {field.name: kind(field.type) for field in ours.schema}
    other = {field.name: kind(field.type) for field in theirs.schema}
    found = []
    if kinds != other:
        found.append(f"schema {sorted(set(kinds.items()) ^ set(other.items()))}")
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows {ours.num_rows} vs {theirs.num_rows}")
    elif set(kinds) == set(other):
        pairs = zip(lines(ours), lines(theirs), strict=True)
        apart = [pair for pair in pairs if pair[0] != pair[1]]
        if apart:
            found.append(f"{len(apart)} rows differ, first {apart[0]}")
    return found
