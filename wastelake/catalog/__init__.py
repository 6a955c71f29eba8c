"""Example queries over the benchmark tables, one per operator, with their SQL."""

from . import feed_queries, list_queries, map_queries, stats_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
