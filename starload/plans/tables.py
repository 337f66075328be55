"""Reading the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.session import ensure_session_defaults

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_session_defaults(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
