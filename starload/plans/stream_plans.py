"""Queries of the queue consumer (T1–T6, S12) and of id assignment over the whole fact (L4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload import specs
from starload.operators import loading
from starload.plans import fixtures
from starload.plans.registry import register
from starload.plans.rule_plans import CHECKED_SQL, dims_and_targets
from starload.plans.tables import table
from starload.session import scratch_path
from starload.streaming import ingest as stream
from starload.streaming import queue
from starload.streaming.burst import burst_flags_stream, keyed_state

# One micro-batch holds all messages, so repeated ids are looked for over the whole stream.
_ONE_BATCH_SQL = CHECKED_SQL.replace(fixtures.RAW_MESSAGES["batch_id"], "CAST(0 AS BIGINT)")

_STREAM_SQL = (
    _ONE_BATCH_SQL
    + """, outcome AS (
  SELECT CASE WHEN error_type IS NULL AND tbl <> 'hired_employees' AND (id_int IS NULL OR abs(id_int) > 2147483647)
              THEN 'BAD_ID' ELSE coalesce(error_type, 'ACCEPTED') END AS outcome,
         coalesce(tbl, '') AS table_name, id_int
  FROM final
), top AS (
  SELECT greatest((SELECT max(o_orderkey) FROM orders),
                  (SELECT max(id_int) FROM outcome WHERE outcome = 'ACCEPTED' AND table_name = 'hired_employees')) AS id
)
SELECT outcome, table_name, count(*) AS n,
       CAST(CASE WHEN outcome = 'ACCEPTED' THEN coalesce(sum(id_int), 0)
            + (count(*) - count(id_int)) * (SELECT id FROM top) + (count(*) - count(id_int)) * (count(*) - count(id_int) + 1) / 2 END AS BIGINT) AS id_sum
FROM outcome GROUP BY outcome, table_name"""
)


@register("stream_ingest", oracle=_STREAM_SQL, ids=("T1", "T2", "T3", "T4", "T5", "T6", "S12"))
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as JSON-lines files, consumed by the stream until they are used up: what was appended and logged."""
    root = scratch_path(spark, "stream")
    _, targets = dims_and_targets(spark, sf_dir)
    for name, ids in targets.items():
        ids.write.parquet(f"{root}/tables/{name}")
    messages = fixtures.raw_messages(spark, sf_dir)
    messages.select(F.lit("").alias("key"), "value", F.col("_offset").alias("offset")).write.json(f"{root}/source")
    cfg = stream.IngestConfig(
        tables_dir=f"{root}/tables", stream_dir=f"{root}/appended", reject_dir=f"{root}/rejects",
        checkpoint=f"{root}/checkpoint", as_of=fixtures.AS_OF,
    )
    query = stream.start(stream.file_source(spark, f"{root}/source"), cfg, available_now=True)
    query.awaitTermination()
    appended = None
    for name in specs.TABLES:
        part = spark.read.parquet(f"{root}/appended/{name}").select(F.lit(name).alias("table_name"), F.col("id").cast("bigint").alias("id"))
        appended = part if appended is None else appended.unionByName(part)
    accepted = appended.groupBy("table_name").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))
    log = spark.read.parquet(f"{root}/rejects").where(F.col("error_type") != specs.BATCH_SUMMARY)
    rejected = log.groupBy("table_name", F.col("error_type").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return accepted.select(F.lit("ACCEPTED").alias("outcome"), "table_name", "n", "id_sum").unionByName(
        rejected.select("outcome", "table_name", "n", F.lit(None).cast("bigint").alias("id_sum"))
    )


QUEUE_PARTITIONS, FLUSHED, FLUSHES_AT_ONCE = 4, 1000, 1000

_FLUSH_SQL = f"""
WITH m AS (SELECT event_id, user_id % {QUEUE_PARTITIONS} AS p, row_number() OVER (PARTITION BY user_id % {QUEUE_PARTITIONS} ORDER BY event_id) - 1 AS o FROM events WHERE event_id % 7 <> 0),
r AS (SELECT event_id, p, row_number() OVER (ORDER BY o // 1000, p, o) - 1 AS n FROM m)
SELECT n // {FLUSHED} AS batch_id, count(*) AS records, count(DISTINCT p) AS queue_partitions, CAST(sum(event_id) AS BIGINT) AS ids,
       CASE WHEN count(*) = {FLUSHED} THEN 'count' ELSE 'age' END AS flushed_by
FROM r GROUP BY n // {FLUSHED}"""


@register("stream_flush", oracle=_FLUSH_SQL, ids=("T2", "S12", "S13"))
def stream_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of a queue, consumed until it is empty: batches of exactly 1000 in the order of arrival, and a last one that
    goes because its oldest message has waited for two seconds. A micro-batch holds up to a thousand of them, each row with its own's number."""
    root = scratch_path(spark, "queue")
    events = table(spark, sf_dir, "events").where("event_id % 7 <> 0").select((F.col("user_id") % QUEUE_PARTITIONS).cast("int").alias("queue_partition"), "event_id")
    placed = loading.positions(events, ["queue_partition", "event_id"])
    begins = placed.groupBy("queue_partition").agg(F.min("_position").alias("begin"))
    offset = F.col("_position") - F.col("begin")
    envelope = F.to_json(F.struct(F.lit("events").alias("table"), F.struct(F.col("event_id").alias("id")).alias("payload")))
    arrived = F.lit(1_600_000_000_000) + F.floor(offset / queue.SEGMENT) * 1000
    messages = placed.join(F.broadcast(begins), "queue_partition").select(  # one row per queue partition
        F.col("event_id").cast("string").alias("key"), envelope.alias("value"), "queue_partition", offset.alias("offset"), arrived.alias("arrived_ms")
    )
    queue.publish(messages, f"{root}/messages")
    source = queue.queue_source(spark, f"{root}/messages", max_records=FLUSHED, max_batches=FLUSHES_AT_ONCE)

    def flush(batch: DataFrame, batch_id: int) -> None:
        few = batch.coalesce(spark.sparkContext.defaultParallelism)  # the queue's segments are small
        few.select("key", "_offset.partition", "flush").write.mode("overwrite").parquet(f"{root}/flushed/trigger={batch_id}")

    query = source.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(flush).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    batches = spark.read.parquet(f"{root}/flushed").groupBy(F.col("flush").alias("batch_id"))
    out = batches.agg(F.count("*").alias("records"), F.countDistinct("partition").alias("queue_partitions"), F.sum(F.col("key").cast("bigint")).alias("ids"))
    return out.withColumn("flushed_by", F.when(F.col("records") == FLUSHED, "count").otherwise("age"))


# Every 97th event older than a day before the last one comes when its time is long over.
_LATE = "event_id % 97 = 0 AND ts < (SELECT max(ts) FROM events) - INTERVAL '1' DAY"
BURST_LIMIT, BURST_TTL_SECONDS = 3, 6 * 3600


def _burst_stream_sql() -> str:
    ttl = BURST_TTL_SECONDS * 1_000_000
    now = "CASE WHEN e.t >= s.expires THEN 0 ELSE s.cnt END"
    return f"""WITH RECURSIVE e AS (
  SELECT user_id, event_id, epoch_us(ts) AS t, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE NOT ({_LATE})
), s(user_id, rn, event_id, cnt, expires, flagged) AS (
  SELECT user_id, rn, event_id, 1, t + {ttl}, false FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn, e.event_id, least({now} + 1, {BURST_LIMIT}), CASE WHEN {now} >= {BURST_LIMIT} THEN s.expires ELSE e.t + {ttl} END, {now} >= {BURST_LIMIT}
  FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1
)
SELECT CAST(user_id AS VARCHAR) AS user_id, event_id, flagged, false AS late FROM s
UNION ALL SELECT CAST(user_id AS VARCHAR), event_id, NULL, true FROM events WHERE {_LATE}"""


@register("burst_stream", oracle=_burst_stream_sql(), ids=("T8",))
def burst_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as three loads of a stream that is stopped and started again between them: one half, the other half, and those
    that come too late together with a row that only moves the clock."""
    root = scratch_path(spark, "burst-stream")
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    ends = events.agg(F.max("ts").alias("last"), F.min("ts").alias("begin")).select("last", (F.col("last") - F.expr("interval 1 day")).alias("day"), (F.col("begin") + (F.col("last") - F.col("begin")) / 2).alias("middle"))
    held = (F.col("event_id") % 97 == 0) & (F.col("ts") < ends.select("day").scalar())
    half = F.col("ts") < ends.select("middle").scalar()
    tick = ends.select(F.lit(None).cast("bigint").alias("user_id"), (F.col("last") + F.expr("interval 30 days")).alias("ts"), F.lit(None).cast("bigint").alias("event_id"))
    for part in (events.where(~held & half), events.where(~held & ~half), events.where(held).unionByName(tick)):
        part.write.mode("append").parquet(f"{root}/events")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/events")
        flags = burst_flags_stream(stream, key="user_id", ts="ts", tie="event_id", limit=BURST_LIMIT, ttl_seconds=BURST_TTL_SECONDS, watermark="2 hours", slot_seconds=3600)
        with keyed_state(spark):
            query = flags.writeStream.format("parquet").option("path", f"{root}/flags").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.parquet(f"{root}/flags")


@register(
    "assign_ids_wide",
    oracle="""SELECT * REPLACE (CASE WHEN l_linenumber = 1 THEN l_orderkey ELSE
    (SELECT max(l_orderkey) FROM lineitem WHERE l_linenumber = 1)
    + ROW_NUMBER() OVER (PARTITION BY l_linenumber = 1 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) END AS l_orderkey)
FROM lineitem""",
    ids=("L4",),
)
def assign_ids_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fact columns: first lines keep the order's id, the others get new ones in the order of their keys."""
    fact = table(spark, sf_dir, "lineitem")
    order = ["_o", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    rows = fact.withColumn("_o", F.col("l_orderkey")).withColumn("l_orderkey", F.when(F.col("l_linenumber") == 1, F.col("l_orderkey")))
    return loading.assign_ids(rows, order=order, id_col="l_orderkey").select(*fact.columns)
