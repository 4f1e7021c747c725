"""The layered tables as a graph of DataFrame builders."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import Lock
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.config import LayerConfig
from flowlens.operators import aggregates, bridges, dimensions, entities, facts, history
from flowlens.operators.expectations import HeavyKey, Watch, audit, audit_lines, enforce, require, union_all
from flowlens.operators.projections import EXPECTATIONS, PROJECTIONS


# The count that bounds the status changes of one issue.
CHANGES = "changes_of_an_issue"


class Source(Protocol):
    def table(self, name: str) -> DataFrame: ...


class Store(Protocol):
    def save(
        self, name: str, frame: DataFrame, counted: Callable[[], Mapping[str, int]] | None = None
    ) -> DataFrame: ...

    def commit(self) -> object: ...

    def counts(self, name: str) -> Mapping[str, int]: ...


@dataclass(frozen=True)
class Node:
    """How a table is made: a function of its inputs and, if it asks, the settings."""

    build: Callable[..., DataFrame]
    needs: tuple[str, ...]
    configured: bool = False
    # A count of an input's write that ``build`` takes as ``largest``: (table, count).
    largest: tuple[str, str] | None = None
    # The issue's column of each input that can be dealt by issue: the table of all issues is then
    # that of some issues and that of the others, as no row is made of two issues.
    issue_of: Mapping[str, str] = field(default_factory=dict)


def node(
    build: Callable[..., DataFrame],
    needs: str,
    configured: bool = False,
    largest: tuple[str, str] | None = None,
    issue_of: Mapping[str, str] | None = None,
) -> Node:
    return Node(build, tuple(needs.split()), configured, largest, issue_of or {})


def of_slice(frame: DataFrame, column: str, number: int, slices: int) -> DataFrame:
    """The rows of the issues that fall into one of the slices; rows without an issue are in one too."""
    return frame.where(F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(slices)) == number)


def heavy_keys(table: str, config: LayerConfig) -> dict[str, HeavyKey]:
    """Keys whose rows are bounded while a table is written."""
    if table != "silver.issue_field_history":
        return {}
    field = config.status_field_id.replace("'", "''")
    return {CHANGES: HeavyKey("issue_id", f"field_id = '{field}'")}


def _silver() -> dict[str, Node]:
    projected = {
        name: node(projection.build, f"bronze.{projection.source}")
        for name, projection in PROJECTIONS.items()
    }
    values = "bronze.issue_field_values bronze.issue_fields"
    return projected | {
        "issue": node(
            entities.issue,
            "bronze.issues bronze.projects bronze.status bronze.priority bronze.issue_types "
            "bronze.resolutions",
        ),
        "status": node(entities.status, "bronze.status bronze.status_category"),
        "status_category": node(entities.status_category, "bronze.status_category"),
        "issue_field_history": node(history.single_value_history, values),
        "issue_multiselect_history": node(history.multi_value_history, values),
        "issue_link": node(bridges.issue_link, "bronze.issue_links"),
        "sprint_issue": node(bridges.sprint_issue, "bronze.issues"),
        "epic_issue": node(
            lambda issues, types, config: bridges.epic_issue(
                issues, types, config.epic_issue_type_name
            ),
            "bronze.issues bronze.issue_types",
            configured=True,
        ),
        "issue_component": node(
            bridges.issue_component, "bronze.issues silver.component silver.issue"
        ),
        "issue_version": node(
            bridges.issue_version,
            "bronze.issues silver.version silver.project_version silver.issue",
        ),
    }


SILVER = _silver()

# Plans that gold tables share but that are not kept as tables.
STEPS = {
    "first_in_progress": node(
        facts.first_in_progress,
        "silver.issue_field_history silver.status silver.status_category",
        configured=True,
    ),
    "current_sprint": node(facts.current_sprint, "silver.sprint_issue silver.sprint"),
    "status_changes": node(
        facts.status_changes,
        "silver.issue_field_history",
        configured=True,
        largest=("silver.issue_field_history", CHANGES),
    ),
}

GOLD = {
    "dim_user": node(dimensions.dim_user, "silver.user silver.user_group"),
    "dim_project": node(
        dimensions.dim_project, "silver.project silver.project_category silver.user silver.issue"
    ),
    "dim_status": node(dimensions.dim_status, "silver.status silver.status_category"),
    "dim_sprint": node(dimensions.dim_sprint, "silver.sprint silver.board"),
    "dim_date": node(dimensions.dim_date, "silver.issue", configured=True),
    "fct_issue": node(
        facts.fct_issue,
        "silver.issue silver.project silver.issue_type gold.dim_status silver.priority "
        "silver.resolution silver.user silver.epic_issue step.current_sprint gold.dim_sprint "
        "step.first_in_progress",
        configured=True,
        issue_of={
            "silver.issue": "id",
            "silver.epic_issue": "issue_id",
            "step.current_sprint": "issue_id",
            "step.first_in_progress": "issue_id",
        },
    ),
    "fct_issue_transitions": node(
        facts.fct_issue_transitions,
        "step.status_changes silver.issue silver.status silver.status_category",
        issue_of={"step.status_changes": "issue_id", "silver.issue": "id"},
    ),
    "fct_sprint_velocity": node(
        facts.fct_sprint_velocity,
        "silver.sprint_issue silver.sprint silver.issue silver.board silver.project",
    ),
    "fct_worklog": node(
        facts.fct_worklog,
        "silver.issue_worklog silver.issue silver.project silver.user",
        issue_of={"silver.issue_worklog": "issue_id", "silver.issue": "id"},
    ),
    "agg_assignee_load": node(aggregates.agg_assignee_load, "gold.fct_issue"),
    "agg_project_health": node(aggregates.agg_project_health, "gold.fct_issue", configured=True),
    "agg_team_productivity": node(
        aggregates.agg_team_productivity, "gold.fct_issue", configured=True
    ),
    "agg_time_in_status": node(
        aggregates.agg_time_in_status, "gold.fct_issue_transitions silver.project"
    ),
}

# Shared tables of the metric views; views over gold, never stored.
METRICS = {"created_resolved_daily": node(aggregates.created_resolved_daily, "gold.fct_issue")}

# Tables written at a time by one request.
SIDE_BY_SIDE = 8

LAYERS = {"silver": SILVER, "step": STEPS, "gold": GOLD, "metrics": METRICS}


class Pipeline:
    """Silver and gold tables over a source of raw tables.

    Tables are built on demand.  With a store, a table that others read is
    written once and read back, so the readers share one computation and the
    planner knows its real size; without one everything stays lazy.

    Row checks of stored tables are counted while the table is written, and ``build``
    commits all tables at its end.  Without a store a check sits in the plan as a barrier;
    ``check_ahead`` looks at the checked columns first instead, so that filters of later
    queries reach the scans.
    """

    def __init__(
        self,
        source: Source,
        config: LayerConfig | None = None,
        store: Store | None = None,
        landed: Iterable[str] = (),
        check_ahead: bool = False,
    ):
        self.source = source
        self.config = config or LayerConfig()
        self.store = store
        self.landed = tuple(landed)
        self.check_ahead = check_ahead
        self._lock = Lock()
        self._tables: dict[str, Future[DataFrame]] = {}

    def bronze(self, name: str) -> DataFrame:
        return self.table(f"bronze.{name}")

    def silver(self, name: str) -> DataFrame:
        return self.table(f"silver.{name}")

    def gold(self, name: str) -> DataFrame:
        return self.table(f"gold.{name}")

    def metrics(self, name: str) -> DataFrame:
        return self.table(f"metrics.{name}")

    def table(self, key: str) -> DataFrame:
        """A table by ``layer.name``, made on first use by whichever thread asks first."""
        with self._lock:
            mine = key not in self._tables
            table = self._tables.setdefault(key, Future())
        if mine:
            try:
                table.set_result(self._saved(key) if self._kept(key) else self.frame(key))
            except BaseException as error:
                with self._lock:
                    del self._tables[key]
                table.set_exception(error)
        return table.result()

    def _kept(self, key: str) -> bool:
        layer, name = key.split(".")
        return self.store is not None and (
            layer in ("silver", "gold") or (layer == "bronze" and name in self.landed)
        )

    def _saved(self, key: str) -> DataFrame:
        layer, name = key.split(".")
        expectations = EXPECTATIONS.get(name, ()) if layer == "silver" else ()
        slices = getattr(self.store, "slices", 1)
        if slices > 1 and layer == "gold" and LAYERS[layer][name].issue_of:
            first, *further = [self.frame(key, part=(number, slices)) for number in range(slices)]
            return self.store.save(key, first, further=further)
        if not expectations:
            return self.store.save(key, self.frame(key))
        watch = Watch(name, expectations, heavy_keys(key, self.config))
        watched = enforce(watch.over(self.frame(key, checked=False)), name, expectations)
        return self.store.save(key, watched, watch.counts)

    def frame(self, key: str, checked: bool = True, part: tuple[int, int] | None = None) -> DataFrame:
        """The lazy plan of one table over its inputs, with its row checks.

        ``part`` is the number of a slice and how many there are: the rows of its issues only.
        """
        layer, name = key.split(".")
        if layer == "bronze":
            return self.source.table(name)
        made = LAYERS[layer][name]
        inputs = self.tables(made.needs)
        if part:
            inputs = [
                of_slice(frame, made.issue_of[need], *part) if need in made.issue_of else frame
                for need, frame in zip(made.needs, inputs)
            ]
        settings = [self.config] if made.configured else []
        if made.largest and self.store is not None:
            table, count = made.largest
            settings.append(self.store.counts(table).get(count))
        frame = made.build(*inputs, *settings)
        if layer == "silver" and checked:
            check = require if self.check_ahead and self.store is None else enforce
            frame = check(frame, name, EXPECTATIONS.get(name, ()))
        return frame

    def tables(self, keys: Iterable[str]) -> list[DataFrame]:
        """Several tables; those to be written are written side by side.

        Many tables are small, and a job of one leaves most of a cluster idle.
        """
        keys = list(keys)
        if self.store is None or len(keys) < 2:
            return [self.table(key) for key in keys]
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            return list(pool.map(self.table, keys))

    def build(self, layers: Iterable[str] = ("silver", "gold")) -> list[str]:
        """Make every table of the layers, raw tables to be landed first; returns their names."""
        self.tables(f"bronze.{name}" for name in self.landed)
        built = []
        for layer in layers:
            keys = [f"{layer}.{name}" for name in LAYERS[layer]]
            self.tables(keys)
            built += keys
        if self.store is not None:
            self.store.commit()
        return built

    def row_counts(self) -> DataFrame:
        """Rows per silver and gold table."""
        return union_all(
            [
                self.table(key).agg(F.lit(key).alias("table_name"), F.count("*").alias("rows"))
                for key in self.build()
            ]
        )

    def audit(self, action: str | None = None) -> DataFrame:
        """Passed and failed rows of every expectation.

        With a store, these are the counts of the tables' writes: tables not built yet are
        built, and no row is read again.  Without one, one scan per checked table.
        """
        wanted = {
            name: chosen
            for name, expectations in EXPECTATIONS.items()
            if (chosen := [one for one in expectations if action in (None, one.action)])
        }
        if self.store is None:
            frames = [audit(self.frame(f"silver.{name}", checked=False), name, wanted[name]) for name in wanted]
            return union_all(frames)
        built = self.tables(f"silver.{name}" for name in wanted)
        lines = [
            line for name in wanted for line in audit_lines(name, wanted[name], self.store.counts(f"silver.{name}"))
        ]
        columns = zip(("table_name", "expectation", "action", "passed", "failed"), zip(*lines))
        return built[0].sparkSession.createDataFrame(pa.table({name: list(values) for name, values in columns}))
