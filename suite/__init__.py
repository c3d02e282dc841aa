"""Registered queries: each operator on the given tables, next to the SQL that gives the same rows."""

from suite import apply_queries, extract_queries, job_queries, mark_queries, run_queries, value_queries  # noqa: F401
from suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
