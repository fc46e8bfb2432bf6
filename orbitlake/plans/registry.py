"""Registered queries: name -> (function of (spark, sf_dir), SQL with the same result or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers the decorated function under name, with the SQL that gives the same rows."""

    def put(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put
