"""Loading: conform to the target schema, id assignment, staged overwrite, orphans.

* A table is replaced by writing the new rows to a staging folder next to it and swapping the
  folders afterwards: the target is never read and overwritten by the same job, and a failed
  write leaves the old table in place.
* Ids for rows without one continue after the largest stored id. Dense positions come from a
  range-partitioned, sorted pass that is written once to the shared folder: per-partition counts
  (one row per partition) of what was written give each partition its base, and the row number
  inside the partition comes from ``monotonically_increasing_id``. Numbering and counting read the
  same files, so they agree whatever the plan. No single-partition window over the data.
* Referential integrity is set-based: left joins to the distinct dimension keys flag orphans;
  semi joins keep the facts that survive a dimension replace.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starload import specs
from starload.operators.rules import as_int, as_text, field, vtype
from starload.session import delete_path, path_exists, rename_path, scratch_path
from starload.specs import TableSpec

_log = logging.getLogger(__name__)


def route_by_id(records: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """records that carry an explicit id, and those that leave it to the store."""
    v = field(F.col(payload), "id")
    has = v.isNotNull() & (vtype(v) != "VOID")
    return records.where(has), records.where(~has)


def conform(records: DataFrame, spec: TableSpec = specs.HIRED_EMPLOYEES, payload: str = "payload") -> DataFrame:
    """Validated payloads → the target's typed columns (timestamps to whole seconds).

    Names are stored as sent (validation trimmed them only to check them).
    """
    p = F.col(payload)
    cols: list[Column] = []
    for f in spec.schema.fields:
        v = field(p, f.name)
        if f.name == spec.ts_column:
            parsed = F.try_to_timestamp(F.try_variant_get(v, "$", "string")).cast("timestamp_ntz")
            cols.append(F.date_trunc("second", parsed).cast("timestamp_ntz").alias(f.name))
        elif f.name == spec.name_column:
            cols.append(as_text(v).alias(f.name))
        else:
            cols.append(as_int(v).try_cast(f.dataType).alias(f.name))  # beyond the type: null
    return records.select(*[c for c in records.columns if c != payload], *cols)


def _ranked(df: DataFrame, order: list[str] | tuple[str, ...], n_partitions: int | None) -> DataFrame:
    """Rows in range partitions, sorted, tagged with partition and row number, written once and read back.

    Range boundaries are sampled, so two runs of the same exchange may cut differently; what was
    written is one cut. Without ``n_partitions`` the session's shuffle sizing applies.
    """
    ranged = df.repartitionByRange(n_partitions, *order) if n_partitions else df.repartitionByRange(*order)
    tagged = ranged.sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mono")
    )
    path = scratch_path(df.sparkSession, "ranked")
    tagged.write.parquet(path)
    return df.sparkSession.read.schema(tagged.schema).parquet(path)


def _bases(counts: DataFrame) -> DataFrame:
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count
    return counts.select("*", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))


def _row_in_partition() -> Column:
    return F.col("_mono") - F.shiftleft(F.col("_pid").cast("bigint"), 33)


def positions(df: DataFrame, order: list[str] | tuple[str, ...], n_partitions: int | None = None) -> DataFrame:
    """Adds ``_position``: 0-based rank of each row by ``order`` (which must be unique).

    Per-partition counts give each partition its base; the row number inside a partition comes
    from ``monotonically_increasing_id``. Both uses read the same written rows.
    """
    cols = df.columns
    tagged = _ranked(df, order, n_partitions)
    bases = _bases(tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")))
    out = tagged.join(F.broadcast(bases.select("_pid", "_base")), "_pid")
    return out.select(*cols, (F.col("_base") + _row_in_partition()).alias("_position"))


def assign_ids(
    df: DataFrame,
    *,
    order: list[str] | tuple[str, ...],
    stored_ids: DataFrame | None = None,
    id_col: str = "id",
    n_partitions: int | None = None,
) -> DataFrame:
    """L4: rows without an id get max(stored ids, explicit ids in the input) + 1, + 2, … in ``order``.

    One ranked pass: rows without an id sort first, so their rank is their place among them;
    the per-partition summary that gives the bases also carries each partition's largest id.
    """
    cols = df.columns
    keyed = df.select("*", F.col(id_col).isNotNull().alias("_has_id"))
    tagged = _ranked(keyed, ["_has_id", *order], n_partitions)
    summary = tagged.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.col(id_col).cast("bigint")).alias("_max_id")
    )
    bases = _bases(summary).select(
        "_pid", "_base", F.max("_max_id").over(Window.partitionBy()).alias("_highest")
    )
    out = tagged.join(F.broadcast(bases), "_pid")
    highest = F.col("_highest")
    if stored_ids is not None:
        highest = F.greatest(highest, stored_ids.select(F.max(stored_ids.columns[0]).cast("bigint")).scalar())
    new_id = F.coalesce(highest, F.lit(0)) + F.col("_base") + _row_in_partition() + 1
    return out.select(
        *[F.coalesce(F.col(id_col).cast("bigint"), new_id).alias(id_col) if c == id_col else F.col(c) for c in cols]
    )


def assign_batches(df: DataFrame, *, order: list[str] | tuple[str, ...], batch_size: int = specs.LOAD_BATCH_SIZE) -> DataFrame:
    """Batch number ``position // batch_size + 1`` over the ordered rows."""
    pos = positions(df, order)
    return pos.withColumn("batch_no", (F.floor(F.col("_position") / batch_size) + 1).cast("bigint")).drop("_position")


def _flag_present(fact: DataFrame, fk: str, dim_ids: DataFrame, flag: str) -> DataFrame:
    keys = dim_ids.select(F.col(dim_ids.columns[0]).alias("_dk")).distinct().withColumn(flag, F.lit(True))
    j = fact.join(keys, fact[fk] == keys["_dk"], "left").drop("_dk")
    return j.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def mark_orphans(fact: DataFrame, refs: dict[str, DataFrame]) -> DataFrame:
    """All fact rows; ``orphan_column`` names the first foreign key (in ``refs`` order) that is absent from its dimension, if any."""
    flagged = fact
    flags = []
    for i, (fk, dim_ids) in enumerate(refs.items()):
        flag = f"_has_{i}"
        flagged = _flag_present(flagged, fk, dim_ids, flag)
        flags.append((fk, flag))
    reason = None
    for fk, flag in flags:
        reason = F.when(~F.col(flag), F.lit(fk)) if reason is None else reason.when(~F.col(flag), F.lit(fk))
    return flagged.withColumn("orphan_column", reason).select(*fact.columns, "orphan_column")


def orphans(fact: DataFrame, refs: dict[str, DataFrame]) -> DataFrame:
    """Fact rows with a foreign key absent from its dimension, named by ``orphan_column``."""
    return mark_orphans(fact, refs).where(F.col("orphan_column").isNotNull())


def cascade_keep(fact: DataFrame, refs: dict[str, DataFrame]) -> DataFrame:
    """Facts that survive replacing their dimensions (every key still present)."""
    out = fact
    for fk, dim_ids in refs.items():
        keys = dim_ids.select(F.col(dim_ids.columns[0]).alias("_dk")).distinct()
        out = out.join(keys, out[fk] == keys["_dk"], "left_semi")
    return out


def append(df: DataFrame, path: str) -> None:
    """L2: append rows; parallel partition writes (for a JDBC target use option batchsize)."""
    df.write.mode("append").parquet(path)


def staged_overwrite(df: DataFrame, path: str) -> int:
    """L1: write to a staging folder beside the target, then swap. Returns the row count."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.__staging"
    delete_path(spark, staging)
    df.write.mode("overwrite").parquet(staging)
    n = spark.read.parquet(staging).count()
    old = f"{path.rstrip('/')}.__old"
    delete_path(spark, old)
    if path_exists(spark, path) and not rename_path(spark, path, old):
        raise OSError(f"could not move {path} aside")
    if not rename_path(spark, staging, path):
        if path_exists(spark, old):
            rename_path(spark, old, path)
        raise OSError(f"could not move {staging} to {path}")
    delete_path(spark, old)
    return n


@dataclass(frozen=True)
class LoadStatus:
    table: str
    status: str
    rows_loaded: int
    rows_rejected: int


def full_load(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    target_dir: str,
    *,
    position: dict[str, str | tuple[str, ...]] | None = None,
    reject_dir: str | None = None,
) -> DataFrame:
    """Dims first, then the fact; each table cleaned, conformed, orphans rejected, staged
    and swapped. Stops at the first failure; returns one status row per table."""
    from starload.operators import cleaning

    statuses: list[LoadStatus] = []
    failed = False
    for name in specs.LOAD_ORDER:
        spec = specs.TABLES[name]
        if failed:
            statuses.append(LoadStatus(name, "skipped", 0, 0))
            continue
        if name not in raw:
            statuses.append(LoadStatus(name, "file_not_found", 0, 0))
            continue
        try:
            pos = (position or {}).get(name, cleaning.POSITION)
            staged_rows = f"{target_dir}/_staging/{name}"

            def stage(ann: DataFrame, path: str = staged_rows) -> DataFrame:
                # annotated rows written once to the shared folder: kept rows, rejects and
                # orphans all read them back instead of re-running the parse chain
                ann.write.mode("overwrite").parquet(path)
                return spark.read.parquet(path)

            res = cleaning.clean(raw[name], spec, position=pos, stage=stage)
            kept = res.kept.select(*spec.columns)
            dropped = res.dropped.select(F.col("_drop_step").alias("reason"), "_raw")
            if spec.refs:
                refs = {
                    r.column: spark.read.parquet(f"{target_dir}/{r.table}").select(r.key) for r in spec.refs
                }
                # kept rows and orphans are what one pass over the dimensions' keys tells apart, written once
                marked = stage(mark_orphans(kept, refs), f"{target_dir}/_staging/{name}_marked")
                orph = marked.where(F.col("orphan_column").isNotNull())
                kept = marked.where(F.col("orphan_column").isNull()).select(*spec.columns)
                dropped = dropped.unionByName(
                    orph.select(
                        F.concat(F.lit("orphan:"), F.col("orphan_column")).alias("reason"),
                        F.to_json(F.struct(*spec.columns)).alias("_raw"),
                    )
                )
            n = staged_overwrite(kept, f"{target_dir}/{name}")
            rej_path = f"{reject_dir or target_dir + '/_rejects'}/{name}"
            dropped.write.mode("overwrite").parquet(rej_path)
            statuses.append(LoadStatus(name, "success", n, spark.read.parquet(rej_path).count()))
        except Exception:  # noqa: BLE001 - status is reported, later tables are skipped
            _log.exception("loading %s failed; later tables are skipped", name)
            failed = True
            statuses.append(LoadStatus(name, "failed", 0, 0))
    return spark.createDataFrame(
        [(s.table, s.status, s.rows_loaded, s.rows_rejected) for s in statuses],
        "table string, status string, rows_loaded bigint, rows_rejected bigint",
    )
