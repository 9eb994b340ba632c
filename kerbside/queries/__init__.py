"""All queries by name, and their SQL."""

from .registry import ORACLES, QUERIES
from . import aggregates, attention, estimators, joins, processes, reports, scalars, streams, windows  # noqa: F401  each registers its own

__all__ = ["ORACLES", "QUERIES"]
