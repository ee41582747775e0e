"""The queries of the library by name, and their DuckDB counterparts."""

from __future__ import annotations

from .plans import feature_plans, learning_plans, series_plans, spectral_plans, task_plans  # noqa: F401  they register their queries
from .plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
