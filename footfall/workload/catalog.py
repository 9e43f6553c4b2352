"""All registered queries and check SQL."""

from __future__ import annotations

from footfall.workload import queries, advertising, counting, sharing, normalising, storing, streams  # noqa: F401  (registers)
from footfall.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
