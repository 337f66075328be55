"""Message envelopes ``{"table": STRING, "payload": OBJECT}`` (no other keys).

Parsing keeps every message: an invalid one is flagged, never dropped, so it can be logged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload import specs

ENVELOPE_KEYS = ("payload", "table")


def parse_envelope(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``table`` (string), ``payload`` (VARIANT) and ``envelope_ok`` (boolean).

    Valid: the text is JSON, an object with exactly the keys table and payload, the table a
    string and the payload an object.
    """
    v = F.try_parse_json(F.col(value))
    keys = F.array_sort(F.json_object_keys(F.col(value)))
    table_v = F.try_variant_get(v, "$.table", "variant")
    payload_v = F.try_variant_get(v, "$.payload", "variant")
    ok = (
        v.isNotNull()
        & F.coalesce(keys == F.array(*[F.lit(k) for k in ENVELOPE_KEYS]), F.lit(False))
        & F.coalesce(F.schema_of_variant(table_v) == "STRING", F.lit(False))
        & F.coalesce(F.schema_of_variant(payload_v).startswith("OBJECT"), F.lit(False))
    )
    return messages.select(
        "*",
        F.when(ok, F.try_variant_get(v, "$.table", "string")).alias("table"),
        F.when(ok, payload_v).alias("payload"),
        ok.alias("envelope_ok"),
    )


def known_table(table: Column, tables: tuple[str, ...] = tuple(specs.TABLES)) -> Column:
    return F.coalesce(table.isin(*tables), F.lit(False))


def to_envelope(records: DataFrame, table: str, key: str = "id", topic_prefix: str = "raw.") -> DataFrame:
    """Records of one table → queue rows: key = id text or "", value = envelope JSON, topic."""
    payload = F.struct(*[F.col(c) for c in records.columns])
    return records.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key") if key in records.columns else F.lit("").alias("key"),
        F.to_json(F.struct(F.lit(table).alias("table"), payload.alias("payload"))).alias("value"),
        F.lit(topic_prefix + table).alias("topic"),
    )


def write_queue(envelopes: DataFrame, servers: str, *, linger_ms: int = 10, batch_messages: int = 1000) -> None:
    """Publish ``key``, ``value``, ``topic`` rows to Kafka (needs the Kafka connector jar).

    Producer batching as in the original: a short linger and batches of up to 1000 messages.
    """
    (
        envelopes.select("key", "value", "topic")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.linger.ms", linger_ms)
        .option("kafka.batch.size", batch_messages * 1024)
        .save()
    )
