"""Metric views bound to the gold tables of a pipeline."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame

from flowlens.operators.aggregates import created_resolved_daily
from flowlens.plans.pipeline import METRICS, Pipeline
from flowlens.semantic.model import BoundView, MetricView
from flowlens.semantic.summary import BoundSummary, Summary
from flowlens.semantic.views import all_views, summaries


class MetricLayer:
    def __init__(self, pipeline: Pipeline):
        self.pipeline = pipeline
        self.config = pipeline.config

    @cached_property
    def views(self) -> dict[str, MetricView]:
        return all_views(self.config)

    def table(self, name: str) -> DataFrame:
        return self.pipeline.metrics(name) if name in METRICS else self.pipeline.gold(name)

    def publish(self) -> list[str]:
        """Make the shared tables temporary views ``vw_<table>`` of Spark SQL; returns their names."""
        names = []
        for table in METRICS:
            names.append(f"vw_{table}")
            self.table(table).createOrReplaceTempView(names[-1])
        return names

    def view(self, name: str) -> BoundView:
        return BoundView(self.views[f"metric_{name}"], self.table)

    @cached_property
    def _summaries(self) -> dict[str, Summary]:
        return summaries(self.config)

    @cached_property
    def _summarised(self) -> dict[str, DataFrame]:
        return {}

    def summary(self, name: str) -> BoundSummary:
        """A summary of a view; its rows are written on first use where there is a store."""
        spec = self._summaries[name]

        def stored() -> DataFrame:
            if name not in self._summarised:
                frame = bound.build()
                store = self.pipeline.store
                self._summarised[name] = store.save(f"summary.{name}", frame) if store else frame
            return self._summarised[name]

        bound = BoundSummary(spec, self.view(spec.view), stored)
        return bound

    def summarise(self) -> list[str]:
        """Write all summaries and make them current; returns their names."""
        for name in self._summaries:
            self.summary(name).rows()
        if self.pipeline.store is not None:
            self.pipeline.store.commit()
        return list(self._summaries)

    def flow_since(self, first_day: Column) -> BoundView:
        """The flow view over the days from ``first_day`` on."""
        days = created_resolved_daily(self.pipeline.gold("fct_issue"), first_day)
        view = self.views["metric_flow"]
        return BoundView(view, lambda name: days if name == view.table else self.table(name))
