"""The append-only reject log: rows, batch summaries, and the queries run over it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload import specs
from starload.functions.text import severity, shorten


def reject_rows(
    checked: DataFrame,
    *,
    log_id: Column,
    timestamp: Column,
    record_id: Column,
    raw_data: Column | None = None,
) -> DataFrame:
    """Rejected records in the reject-log shape (S14). ``raw_data`` is the payload, or the message's own
    text where no payload could be read from it."""
    raw = raw_data if raw_data is not None else F.to_json(F.col("payload"))
    if raw_data is None and "value" in checked.columns:
        raw = F.coalesce(raw, F.col("value"))
    return checked.where(F.col("error_type").isNotNull()).select(
        log_id.cast("bigint").alias("id"),
        timestamp.cast("timestamp_ntz").alias("timestamp"),
        F.coalesce(F.col("table"), F.lit("")).alias("table_name"),
        record_id.alias("record_id"),
        F.col("error_type"),
        F.col("error_message"),
        raw.alias("raw_data"),
    )


def batch_summary(checked: DataFrame, group: tuple[str, ...] = ("table", "batch_id"), only_failed: bool = True) -> DataFrame:
    """Per batch, totals and success rate (2 decimals, 0 for an empty batch); by default only
    batches with at least one failure are written."""
    agg = checked.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("error_type").isNull()).alias("valid_records"),
        F.count_if(F.col("error_type").isNotNull()).alias("failed_records"),
    )
    out = agg.select(
        *group,
        F.lit(specs.BATCH_SUMMARY).alias("error_type"),
        "total_records",
        "valid_records",
        "failed_records",
        F.when(F.col("total_records") > 0, F.round(F.col("valid_records") * 100.0 / F.col("total_records"), 2))
        .otherwise(F.lit(0.0))
        .alias("success_rate"),
        F.format_string(
            "batch processed: %d/%d records valid, %d failed validation",
            F.col("valid_records"), F.col("total_records"), F.col("failed_records"),
        ).alias("error_message"),
    )
    return out.where(F.col("failed_records") > 0) if only_failed else out


def batch_reply(checked: DataFrame, group: tuple[str, ...] = ("table", "batch_id")) -> DataFrame:
    """Accepted and rejected counts per call, and the reply status (202 when anything was
    accepted, else 400)."""
    agg = checked.groupBy(*group).agg(
        F.count_if(F.col("error_type").isNull()).alias("accepted"),
        F.count_if(F.col("error_type").isNotNull()).alias("rejected"),
    )
    return agg.withColumn("status", F.when(F.col("accepted") > 0, F.lit(202)).otherwise(F.lit(400)))


def batch_contract(messages: DataFrame, group: tuple[str, ...] = ("table", "batch_id")) -> DataFrame:
    """a call names a known table and carries 1..1000 records."""
    agg = messages.groupBy(*group).agg(F.count(F.lit(1)).alias("n_records"))
    ok = (
        F.coalesce(F.col(group[0]).isin(*specs.TABLES), F.lit(False))
        & (F.col("n_records") >= 1)
        & (F.col("n_records") <= specs.MAX_RECORDS_PER_CALL)
    )
    return agg.withColumn("contract_ok", ok)


def append_log(log: DataFrame, path: str) -> None:
    """Append entries to the stored log, which is partitioned by day."""
    log.withColumn("day", F.to_date("timestamp")).write.mode("append").partitionBy("day").parquet(path)


def stored_log(spark: SparkSession, path: str) -> DataFrame:
    """The stored log. A filter on its ``day`` reads those days' folders only."""
    return spark.read.parquet(path)


def enforce_contract(messages: DataFrame, batch: str = "batch_id") -> DataFrame:
    """adds ``contract_ok``, whether the message's call carries 1..1000 records. Sizes are pre-aggregated."""
    sizes = messages.groupBy(F.col(batch).alias("_call")).agg(F.count(F.lit(1)).alias("_records"))
    joined = messages.join(sizes, F.col(batch).eqNullSafe(F.col("_call")))
    return joined.withColumn("contract_ok", F.col("_records").between(1, specs.MAX_RECORDS_PER_CALL)).drop("_call", "_records")


def call_reply(checked: DataFrame, batch: str = "batch_id", index: str = "record_id") -> DataFrame:
    """Per call the records accepted and rejected, the status, and the list of errors by record.

    Only calls inside the contract come here, so a list has at most 1000 entries.
    """
    error = F.when(F.col("error_type").isNotNull(), F.struct(F.col(index).cast("int").alias("record"), F.col("error_message").alias("error")))
    agg = checked.groupBy(batch).agg(
        F.count_if(F.col("error_type").isNull()).alias("accepted"),
        F.count_if(F.col("error_type").isNotNull()).alias("rejected"),
        F.sort_array(F.collect_list(error)).alias("errors"),
    )
    return agg.withColumn("status", F.when(F.col("accepted") > 0, F.lit(202)).otherwise(F.lit(400)))


def refused_reply(messages: DataFrame, batch: str = "batch_id") -> DataFrame:
    """The reply to calls outside the contract: nothing is checked or inserted, and one error says why."""
    why = F.struct(F.lit(None).cast("int").alias("record"), F.lit("BATCH_SIZE").alias("error"))
    return messages.groupBy(batch).agg(F.lit(0).cast("bigint").alias("accepted"), F.count(F.lit(1)).alias("rejected")).select(
        batch, "accepted", "rejected", F.array(why).alias("errors"), F.lit(400).alias("status")
    )


def log_filter(
    log: DataFrame,
    *,
    as_of: dt.datetime | str,
    last_hours: int = specs.LOG_LAST_HOURS,
    table: str | None = None,
    error_type: str | None = None,
) -> DataFrame:
    """entries of the last N hours before ``as_of`` (a parameter, never ``now()``)."""
    end = F.lit(as_of if isinstance(as_of, str) else as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    since = end - F.make_dt_interval(hours=F.lit(last_hours))
    out = log.where(F.col("timestamp") >= since)
    if "day" in log.columns:  # a stored log: only these days' folders are read
        out = out.where(F.col("day") >= F.to_date(since))
    if table is not None:
        out = out.where(F.col("table_name") == table)
    if error_type is not None:
        out = out.where(F.col("error_type") == error_type)
    return out


def latest(log: DataFrame, n: int = specs.LOG_LIMIT, ts: str = "timestamp", tie: str = "id") -> DataFrame:
    """O3: the newest ``n`` entries (top-k: each task keeps its best n, then one merge of those)."""
    return log.orderBy(F.desc(ts), F.desc(tie)).limit(n)


def log_summary(log: DataFrame) -> DataFrame:
    """Totals per table, per error type, and overall in one pass (grouping sets)."""
    agg = log.groupingSets([["table_name"], ["error_type"], []], "table_name", "error_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.grouping("table_name").alias("_g_table"),
        F.grouping("error_type").alias("_g_type"),
    )
    return agg.select(
        F.when(F.col("_g_table") == 0, F.lit("table"))
        .when(F.col("_g_type") == 0, F.lit("error_type"))
        .otherwise(F.lit("total"))
        .alias("level"),
        F.coalesce(F.col("table_name"), F.col("error_type"), F.lit("")).alias("value"),
        "n",
    )


def log_date_rollup(log: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Counts by year, month, day with subtotals (year → month → day drill-down)."""
    return (
        log.select(F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"))
        .rollup("year", "month", "day")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def log_search(log: DataFrame, term: str, columns: tuple[str, ...] = ("table_name", "error_message", "record_id")) -> DataFrame:
    """case-insensitive substring match in any of the columns."""
    t = term.lower()
    cond = None
    for c in columns:
        hit = F.coalesce(F.lower(F.col(c)).contains(t), F.lit(False))
        cond = hit if cond is None else (cond | hit)
    return log.where(cond)


def with_display(log: DataFrame) -> DataFrame:
    """Shortened message and severity class per entry."""
    return log.select(
        "id", "error_type",
        shorten("error_message").alias("message_short"),
        severity("error_type").alias("severity"),
    )
