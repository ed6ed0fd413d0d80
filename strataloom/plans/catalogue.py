"""Named queries over the driver's tables, each with its oracle SQL where SQL can express it."""

from __future__ import annotations

from strataloom.plans import analysis_queries, build_queries, conflict_queries, ingest_queries, store_queries  # noqa: F401  (they register themselves)
from strataloom.plans.registry import ORACLE, QUERIES  # noqa: F401
