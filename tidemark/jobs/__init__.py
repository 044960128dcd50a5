"""Registered queries: each runs over the given tables; most have a SQL oracle."""

from __future__ import annotations

from tidemark.jobs.registry import ORACLES, QUERIES
from tidemark.jobs import (  # noqa: F401  (importing registers the queries)
    aggregates, changing, detection, joins, late, models, ranking, routing, sources, sinks, streams, windows,
    rule_streams,
)

__all__ = ["ORACLES", "QUERIES"]
