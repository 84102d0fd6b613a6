"""All registered queries."""

from __future__ import annotations

from millrace.plans import landing_queries, merge_queries, watch_queries  # noqa: F401
from millrace.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
