"""Checks of the library on the given tables: the trip domain, the queries and their SQL oracles."""

from checks import file_queries, mart_queries, other_queries, table_queries  # noqa: F401
from checks.registry import QUERIES

__all__ = ["QUERIES"]
