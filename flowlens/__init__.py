"""Delivery analytics over issue-tracker tables, written as Spark DataFrame jobs."""

from flowlens.config import LayerConfig
from flowlens.plans.pipeline import Pipeline
from flowlens.semantic.layer import MetricLayer

__all__ = ["LayerConfig", "MetricLayer", "Pipeline"]
