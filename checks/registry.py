"""Registered queries: a Spark callable, its SQL oracle, and the survey rows it covers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from checks.domain import duck
from checks.oracle_views import ORACLE_VIEWS


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None, name: str | None = None):
    """Register a function as a query. ``covers`` lists survey rows; ``sql`` may use the oracle's views."""
    def register(fn):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = Query(fn, duck(sql, ORACLE_VIEWS) if sql else None, tuple(covers.split()))
        return fn
    return register
