"""Registered queries over the generic test tables."""
from . import anomalies, builds, change, graph, health, layout, logs, metrics, projections, quality, reports, sampling, seasonal, sketches, sources, spans, streams, templates, trees  # noqa: F401
from .book import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
