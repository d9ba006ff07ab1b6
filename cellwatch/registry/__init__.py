"""Every query, runnable on a folder of benchmark tables."""

from cellwatch.registry import days, inputs, jobs, scores, windows  # noqa: F401
from cellwatch.registry.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
