"""Registered queries: every operator on the given tables, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL twin if there is one."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return register


def load_all() -> None:
    from lakegauge.suite import (  # noqa: F401
        aggregates, baselines, checks, files, inference, joins, prepared, rollups)
