"""Independent SQL for every registered query, run by the check tool."""

from oracle.sql import oracle_queries

__all__ = ["oracle_queries"]
