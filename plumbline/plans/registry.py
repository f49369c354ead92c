"""All queries over the engine's own operators, and their SQL."""

from __future__ import annotations

from plumbline.plans import record_queries  # noqa: F401 (registers its queries)
from plumbline.plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
