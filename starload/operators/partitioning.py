"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a thin input over the cluster before CPU-heavy per-row work.

    A scan yields one task per file split; a small file with a single row group is one task,
    which leaves every other core idle while it parses. When (and only when) the scan has fewer
    partitions than the cluster's default parallelism, rows are hashed on their row id into that
    many partitions. The row id is fixed by the input split and the row's place in it, so a
    retried task sends every row to the same place (round-robin would need a sort for that).
    Large inputs already have thousands of splits, so this adds no shuffle where it would cost.
    """
    from pyspark.sql import functions as F

    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, F.monotonically_increasing_id())
