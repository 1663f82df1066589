"""A book of named queries, each with the DuckDB SQL that it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Book:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"{name} is there already")
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return add
