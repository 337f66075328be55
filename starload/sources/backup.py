"""Parquet snapshots: take, find the latest, restore.

Layout ``<backups>/table=<name>/ts=<yyyymmddThhmmss>/part-*.parquet`` (snappy, at most
``part_rows`` rows per file). Partition folders make "latest" a listing, not a scan.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload import specs
from starload.operators.loading import assign_ids, staged_overwrite
from starload.session import list_dirs, path_exists

_STAMP = re.compile(specs.BACKUP_STAMP_PATTERN)


def stamp_of(moment: dt.datetime) -> str:
    return moment.strftime("%Y%m%dT%H%M%S")


def snapshot_path(backups_dir: str, table: str, stamp: str) -> str:
    return f"{backups_dir.rstrip('/')}/table={table}/ts={stamp}"


def take_snapshot(
    df: DataFrame,
    backups_dir: str,
    table: str,
    *,
    as_of: dt.datetime,
    part_rows: int = specs.BACKUP_PART_ROWS_CLI,
) -> str:
    """Write the table as a snapshot; returns its path. An empty table still writes a
    readable, schema-only part. The same tables are taken as are restored."""
    _known(table)
    path = snapshot_path(backups_dir, table, stamp_of(as_of))
    (
        df.write.mode("errorifexists")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", part_rows)
        .parquet(path)
    )
    return path


def snapshots(spark: SparkSession, backups_dir: str, table: str) -> list[str]:
    """Stamps of the table's snapshots, oldest first (a folder listing on the driver)."""
    root = f"{backups_dir.rstrip('/')}/table={table}"
    stamps = [d[3:] for d in list_dirs(spark, root) if d.startswith("ts=")]
    return sorted(s for s in stamps if _STAMP.match(s))


def latest_snapshot(spark: SparkSession, backups_dir: str, table: str) -> str | None:
    """Path of the newest snapshot, or None."""
    stamps = snapshots(spark, backups_dir, table)
    return snapshot_path(backups_dir, table, stamps[-1]) if stamps else None


def _known(table: str) -> None:
    if table not in specs.TABLES:
        raise ValueError(f"table must be one of {sorted(specs.TABLES)}, not {table!r}")


def check_columns(columns: list[str], table: str, expected: tuple[str, ...]) -> None:
    """A snapshot holds just the table's columns; a table whose ids the store may assign can do without them."""
    spec = specs.TABLES[table]
    missing = [c for c in expected if c not in columns and not (spec.id_optional and c == spec.key)]
    extra = [c for c in columns if c not in expected]
    if missing or extra:
        raise ValueError(f"snapshot of {table}: missing columns {missing}, unknown columns {extra}")


def restore(
    spark: SparkSession,
    backups_dir: str,
    table: str,
    target_path: str,
    *,
    backup_path: str | None = None,
    columns: tuple[str, ...] | None = None,
) -> int:
    """Load a snapshot (given, or the latest) into the target, which a staged swap replaces.

    *Before* the target is touched the snapshot is read as far as its footers, and its columns are held against
    ``columns`` (those of the table's spec unless given). Rows without an id, or all of them if the snapshot has no id
    column, get ids behind the highest of the snapshot and of the table that is replaced, in the order of their values, so
    that no id is used twice.
    """
    _known(table)
    path = backup_path or latest_snapshot(spark, backups_dir, table)
    if path is None or not path_exists(spark, path):
        raise FileNotFoundError(f"no snapshot for {table}")
    spec = specs.TABLES[table]
    snap = spark.read.parquet(path)
    expected = columns or spec.columns
    check_columns(snap.columns, table, expected)
    if spec.id_optional and spec.key in expected:
        if spec.key not in snap.columns:
            snap = snap.withColumn(spec.key, F.lit(None).cast(spec.schema[spec.key].dataType))
        if snap.where(F.col(spec.key).isNull()).limit(1).count():
            before = spark.read.parquet(target_path).select(spec.key) if path_exists(spark, target_path) else None
            kind = snap.schema[spec.key].dataType
            snap = assign_ids(snap, order=[c for c in expected if c != spec.key], stored_ids=before, id_col=spec.key)
            snap = snap.withColumn(spec.key, F.col(spec.key).cast(kind))
    return staged_overwrite(snap.select(*expected), target_path)


def latest_rows(spark: SparkSession, backups_dir: str, table: str) -> DataFrame:
    """The newest snapshot read through partition discovery, pruned to one ``ts`` folder."""
    stamps = snapshots(spark, backups_dir, table)
    root = f"{backups_dir.rstrip('/')}/table={table}"
    df = spark.read.option("basePath", root).parquet(root)
    return df.where(F.col("ts").cast("string") == (stamps[-1] if stamps else ""))
