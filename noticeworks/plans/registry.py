"""Queries registered with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.QUERIES: dict[str, Query] = {}
        self.SQL: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def add(f: Query) -> Query:
            self.QUERIES[f.__name__] = f
            if sql:
                self.SQL[f.__name__] = sql
            return f

        return add
