"""A named query: the Spark form and, where SQL can say it, the DuckDB form."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    build: Build
    sql: str | None


class Registry(dict):
    def add(self, name: str, sql: str | None = None) -> Callable[[Build], Build]:
        def register(build: Build) -> Build:
            if name in self:
                raise ValueError(f"query {name!r} is registered twice")
            self[name] = Query(build, sql)
            return build

        return register


registry = Registry()
