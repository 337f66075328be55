"""The queue consumer (T1–T7) as one Structured Streaming query.

``readStream`` (Kafka topics ``raw.<table>``, or a folder of JSON-lines files carrying the same
envelopes) → ``foreachBatch``: check every message against the tables as they are now (the
dimensions are re-read each batch), append accepted rows, write rejects and batch summaries.

Delivery: each micro-batch writes its output under ``batch_id=<n>`` folders with overwrite, so a
batch replayed after a failure replaces its own output instead of duplicating it; together with
the checkpoint this gives effectively-once results (the reference could silently drop a failed
flush). Ids count as stored only from batches before it, so a replay accepts what the first run
accepted. From ``queue.queue_source`` batches come by the flush rule, 1000 records or 2 s; with other sources
the trigger interval stands in for the 2 s, and the caller may cap a trigger's records.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starload import specs
from starload.operators import ingest, loading, rejects, rules
from starload.operators.id_leases import IdLeases, assign_leased
from starload.operators.id_store import IdStore
from starload.session import list_dirs, path_exists
from starload.sources.envelope import parse_envelope

KAFKA_TOPICS = ",".join(f"raw.{t}" for t in specs.TABLES)


@dataclass
class IngestConfig:
    tables_dir: str          # current tables: <tables_dir>/<table>
    stream_dir: str          # appended rows: <stream_dir>/<table>/batch_id=<n>
    reject_dir: str          # reject log: <reject_dir>/batch_id=<n>
    checkpoint: str          # streaming checkpoint (shared storage)
    as_of: dt.datetime | str | None = None   # validation clock; None = latest arrival in the batch
    dims_from: dict[str, str] = field(default_factory=dict)  # optional override of dim folders
    id_leases: str | None = None  # ranges of ids leased by batch, so that no maximum over stored ids is looked for
    id_store: str | None = None  # stored ids by table, so that a batch's cost does not grow with what was stored before


def kafka_source(spark: SparkSession, servers: str, topics: str = KAFKA_TOPICS, max_offsets: int | None = None) -> DataFrame:
    """Kafka topics from the earliest offset; ``max_offsets`` (unset: all that is there) caps a micro-batch."""
    source = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", "earliest")
    )
    raw = (source.option("maxOffsetsPerTrigger", max_offsets) if max_offsets else source).load()
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.struct("topic", "partition", "offset").alias("_offset"),
        F.col("timestamp").cast("timestamp_ntz").alias("arrived"),
    )


def file_source(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """JSON-lines files ``{"key": ..., "value": "<envelope>", "offset": n}``; ``max_files``
    (unset: all that is there) caps a micro-batch. The message order is (file, offset)."""
    source = spark.readStream.schema("key string, value string, offset long")
    raw = (source.option("maxFilesPerTrigger", max_files) if max_files else source).json(folder)
    return raw.select(
        "key",
        "value",
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("offset")).alias("_offset"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("arrived"),
    )


def _read_ids(spark: SparkSession, path: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.parquet(path).select(F.col("id").cast("bigint").alias("id"))
    return spark.createDataFrame([], "id bigint")


def _earlier(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """Ids that batches before ``batch_id`` appended: a replayed batch does not meet its own rows."""
    if not any(int(d.split("=")[1]) < batch_id for d in list_dirs(spark, path) if d.startswith("batch_id=")):
        return spark.createDataFrame([], "id bigint")
    return spark.read.parquet(path).where(F.col("batch_id") < batch_id).select(F.col("id").cast("bigint").alias("id"))


def _named_ids(msgs: DataFrame) -> dict[str, DataFrame]:
    """Per table the ids that the messages name: their own ones, and those of the rows that facts refer to."""
    parsed = parse_envelope(msgs).where("envelope_ok")
    named = lambda t, column: parsed.where(F.col("table") == t).select(rules.as_int(rules.field(F.col("payload"), column)).alias("id"))
    out = {t: named(t, s.key) for t, s in specs.TABLES.items()}
    for t, s in specs.TABLES.items():
        for r in s.refs:
            out[r.table] = out[r.table].unionByName(named(t, r.column))
    return out


def _probed(msgs: DataFrame, batch_id: int, cfg: IngestConfig) -> tuple[dict[str, IdStore], dict[str, DataFrame]]:
    """The stores, and of the ids that the batch names those that are stored."""
    spark = msgs.sparkSession
    stores = {t: IdStore(spark, f"{cfg.id_store}/{t}") for t in specs.TABLES}
    named = _named_ids(msgs)
    found = {}
    for t, store in stores.items():
        store.begin(_read_ids(spark, cfg.dims_from.get(t, f"{cfg.tables_dir}/{t}")))
        store.compact(batch_id)
        found[t] = store.probe(named[t], before=batch_id)
    return stores, found


def require_dimension_ids(checked: DataFrame) -> DataFrame:
    """A dimension row needs an id that its column can hold; others are rejected as ``BAD_ID``."""
    dims = [n for n, s in specs.TABLES.items() if not s.id_optional]
    bad = F.col("error_type").isNull() & F.col("table").isin(*dims) & F.col("_payload_id").try_cast("int").isNull()
    return checked.withColumns(
        {
            "error_codes": F.when(bad, F.array(F.lit(specs.BAD_ID))).otherwise(F.col("error_codes")),
            "error_message": F.when(bad, F.lit(specs.BAD_ID)).otherwise(F.col("error_message")),
            "error_type": F.when(bad, F.lit(specs.BAD_ID)).otherwise(F.col("error_type")),
        }
    )


def process_batch(batch: DataFrame, batch_id: int, cfg: IngestConfig) -> None:
    """One micro-batch: validate, append accepted (ids assigned where missing), log rejects."""
    spark = batch.sparkSession
    msgs = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).persist()
    # a clock carried by the data: a replayed batch judges "future" exactly as the first run did
    as_of = cfg.as_of or msgs.select(F.max("arrived")).scalar()
    try:
        stores: dict[str, IdStore] = {}
        if cfg.id_store:
            stores, targets = _probed(msgs, batch_id, cfg)
        else:
            stored = {t: _read_ids(spark, cfg.dims_from.get(t, f"{cfg.tables_dir}/{t}")) for t in specs.TABLES}
            streamed = {t: _earlier(spark, f"{cfg.stream_dir}/{t}", batch_id) for t in specs.TABLES}
            targets = {t: stored[t].unionByName(streamed[t]) for t in specs.TABLES}
        dims = {t: targets[t] for t in ("departments", "jobs")}
        checked = require_dimension_ids(ingest.check_messages(msgs, dims=dims, targets=targets, as_of=as_of)).persist()
        for name, spec in specs.TABLES.items():
            accepted = checked.where(F.col("error_type").isNull() & (F.col("table") == name))
            rows = loading.conform(accepted.select("_offset", "payload"), spec)
            if spec.id_optional and cfg.id_leases:
                leases = IdLeases(spark, f"{cfg.id_leases}/{name}")
                if not leases.begun():  # once: what was stored before the first lease
                    key = targets[name].columns[0]
                    before = stores[name].highest(before=batch_id) if stores else targets[name].agg(F.max(key).cast("bigint").alias("m")).first().m
                    leases.begin(before or 0)
                rows = assign_leased(rows, leases, batch_id, order=["_offset"])
            elif spec.id_optional:
                known = spark.createDataFrame([(stores[name].highest(before=batch_id),)], "id bigint") if stores else targets[name]
                rows = loading.assign_ids(rows, order=["_offset"], stored_ids=known)
            out = rows.select(*spec.columns)
            appended = f"{cfg.stream_dir}/{name}/batch_id={batch_id}"
            out.write.mode("overwrite").parquet(appended)
            if stores:
                stores[name].add(spark.read.schema(out.schema).parquet(appended).select(spec.key), batch_id)
        # log ids: batch number, then the message's rank in the batch (range-partitioned ranking,
        # no single-task window, whatever the size of the micro-batch)
        ranked = loading.positions(checked, ["_offset"])
        rej = rejects.reject_rows(
            ranked,
            log_id=F.lit(batch_id).cast("bigint") * F.lit(1 << 32) + F.col("_position"),
            timestamp=F.col("arrived"),
            record_id=F.to_json(F.col("_offset")),
        )
        summary = rejects.batch_summary(checked).select(
            F.lit(None).cast("bigint").alias("id"),
            (as_of if not isinstance(as_of, (str, dt.datetime)) else F.lit(as_of)).cast("timestamp_ntz").alias("timestamp"),
            F.col("table").alias("table_name"),
            F.lit(None).cast("string").alias("record_id"),
            "error_type",
            "error_message",
            F.to_json(F.struct("total_records", "valid_records", "failed_records", "success_rate")).alias("raw_data"),
        )
        rej.unionByName(summary).write.mode("overwrite").parquet(f"{cfg.reject_dir}/batch_id={batch_id}")
        checked.unpersist()
    finally:
        msgs.unpersist()


def start(messages: DataFrame, cfg: IngestConfig, *, available_now: bool = False, seconds: int = specs.FLUSH_SECONDS) -> StreamingQuery:
    writer = messages.writeStream.option("checkpointLocation", cfg.checkpoint).foreachBatch(
        lambda df, bid: process_batch(df, bid, cfg)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()
