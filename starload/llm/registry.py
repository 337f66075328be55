"""The queries of this subpackage: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = (build, sql)
        return build

    return add
