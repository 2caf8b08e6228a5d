"""Registered queries: market stand-ins derived from the given tables, and their SQL twins."""

from __future__ import annotations

from workload import (  # noqa: F401  (importing registers the queries)
    landing, versions, rollups, quality, series, joins, repair, streams, live,
)
from workload.base import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
