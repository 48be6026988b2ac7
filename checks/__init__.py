"""Queries over the driver tables and their SQL oracles."""

from checks import clusters, expression, space, statistics, storage  # noqa: F401  (registers the queries)
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
