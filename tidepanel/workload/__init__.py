"""Queries over the given tables and the SQL they are checked against."""

from tidepanel.workload import clean_queries, forecast_queries, profile_queries, test_queries  # noqa: F401
from tidepanel.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
