"""Registry of named queries: a builder ``(spark, sf_dir) -> DataFrame`` and, where the result is
expressible in SQL, an independent DuckDB oracle over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    survey_ids: tuple[str, ...]


QUERIES: dict[str, Query] = {}


def register(name: str, *, oracle: str | None, ids: tuple[str, ...] = ()) -> Callable[[Builder], Builder]:
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = Query(name, fn, oracle, ids)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every plan module so that its queries register themselves."""
    from starload.plans import (  # noqa: F401
        cleaning_plans,
        load_plans,
        log_plans,
        metric_plans,
        rule_plans,
        source_plans,
        stream_plans,
    )

    return QUERIES
