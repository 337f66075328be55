"""Relational targets over JDBC (needs the driver jar on the classpath; untested here).

Reads are split into ranges of a numeric key so that executors read in parallel with a bounded
fetch size; writes are parallel partition inserts in batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload import specs

FETCH_ROWS = 10000


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    properties: dict[str, str] | None = None,
    key: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Full-table scan; with ``key`` and bounds, ``partitions`` parallel range reads."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(FETCH_ROWS), **(properties or {})}
    reader = spark.read.format("jdbc").options(**opts)
    if key is not None and lower is not None and upper is not None and partitions > 1:
        reader = (
            reader.option("partitionColumn", key)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def append_table(
    df: DataFrame,
    url: str,
    table: str,
    *,
    properties: dict[str, str] | None = None,
    batch_rows: int = specs.LOAD_BATCH_SIZE,
) -> None:
    """L2: append in batches of ``batch_rows`` per insert, one connection per partition."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **(properties or {})}
    df.write.format("jdbc").options(**opts).mode("append").save()


def overwrite_table(
    df: DataFrame,
    url: str,
    table: str,
    *,
    properties: dict[str, str] | None = None,
    batch_rows: int = specs.LOAD_BATCH_SIZE,
) -> None:
    """L1: replace the rows but keep the table definition (TRUNCATE instead of DROP)."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_rows), "truncate": "true", **(properties or {})}
    df.write.format("jdbc").options(**opts).mode("overwrite").save()
