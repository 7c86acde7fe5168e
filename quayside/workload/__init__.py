"""The registered queries: each with the plain SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its check in SQL where there is one."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def load_all() -> None:
    from quayside.workload import (  # noqa: F401
        calendars,
        changes,
        entities,
        joins,
        merges,
        metrics,
        nested,
        scalars,
        streams,
        summaries,
        tables,
    )
