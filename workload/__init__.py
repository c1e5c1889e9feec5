"""Queries over the given tables, each with its reference SQL."""

from workload import column_queries, model_queries, source_queries, table_queries  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
