"""Reject-log and audit-log queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload import specs
from starload.functions.nested import map_all_strings
from starload.functions.text import event_colour, format_error, hash_column, json_record, matches_any, nan_to_null, sanitize_text
from starload.operators import rejects
from starload.operators.partitioning import spread
from starload.plans import fixtures
from starload.plans.registry import register
from starload.plans.rule_plans import CHECKED_SQL, reject_log
from starload.plans.tables import table
from starload.session import scratch_path

LOG_AS_OF = "2024-01-20 00:00:00"
LOG_HOURS = 72
SEARCH_TERM = "FK_MISSING(JOB"

REJECT_LOG_SQL = (
    CHECKED_SQL
    + """, reject_log AS (
  SELECT _offset AS id, arrived AS "timestamp", coalesce(tbl, '') AS table_name,
         CAST(_offset % 1000 AS VARCHAR) AS record_id, error_type, error_message
  FROM final WHERE error_type IS NOT NULL
)
"""
)
AUDIT_SQL = f"WITH audit AS ({fixtures.select_sql(fixtures.RAW_AUDIT, 'events')})\n"


@register(
    "log_filter",
    oracle=REJECT_LOG_SQL
    + f"""SELECT id, "timestamp", table_name, error_type FROM reject_log
WHERE "timestamp" >= TIMESTAMP '{LOG_AS_OF}' - INTERVAL {LOG_HOURS} HOUR
  AND table_name = 'hired_employees' AND error_type = 'VALIDATION_ERROR'""",
    ids=("F15", "E7"),
)
def log_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = reject_log(spark, sf_dir)
    out = rejects.log_filter(log, as_of=LOG_AS_OF, last_hours=LOG_HOURS, table="hired_employees", error_type="VALIDATION_ERROR")
    return out.select("id", "timestamp", "table_name", "error_type")


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject log, appended to a store in two writes by parity of the message, and read back."""
    path, checked = scratch_path(spark, "reject-log"), scratch_path(spark, "checked-log")
    found = reject_log(spark, sf_dir)
    found.write.parquet(checked)  # checked once for both writes
    log = spark.read.schema(found.schema).parquet(checked)
    rejects.append_log(log.where("id % 2 = 0"), path)
    rejects.append_log(log.where("id % 2 = 1"), path)
    return rejects.stored_log(spark, path)


@register(
    "stored_log_filter",
    oracle=REJECT_LOG_SQL
    + f"""SELECT id, "timestamp", table_name, error_type FROM reject_log
WHERE "timestamp" >= TIMESTAMP '{LOG_AS_OF}' - INTERVAL {LOG_HOURS} HOUR""",
    ids=("S14", "F15"),
)
def stored_log_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rejects.log_filter(_stored(spark, sf_dir), as_of=LOG_AS_OF, last_hours=LOG_HOURS)
    return out.select("id", "timestamp", "table_name", "error_type")


@register(
    "stored_log_raw",
    oracle=CHECKED_SQL
    + """SELECT _offset AS id, error_type, CASE WHEN error_type = 'INVALID_ENVELOPE' THEN value END AS raw_text, value IS NOT NULL AS has_raw
FROM final WHERE error_type IS NOT NULL""",
    ids=("S14",),
)
def stored_log_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stored log keeps of each message: the text itself where it is no envelope."""
    raw = F.when(F.col("error_type") == specs.INVALID_ENVELOPE, F.col("raw_data"))
    return _stored(spark, sf_dir).select("id", "error_type", raw.alias("raw_text"), F.col("raw_data").isNotNull().alias("has_raw"))


@register(
    "log_last",
    oracle=REJECT_LOG_SQL
    + f"""SELECT id, "timestamp", table_name, record_id, error_type, error_message FROM reject_log
ORDER BY "timestamp" DESC, id DESC LIMIT {specs.LOG_SUMMARY_LAST}""",
    ids=("A9",),
)
def log_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest errors that the log summary ends with."""
    return rejects.latest(reject_log(spark, sf_dir), specs.LOG_SUMMARY_LAST).drop("raw_data")


@register(
    "log_search",
    oracle=REJECT_LOG_SQL
    + f"""SELECT id, table_name, error_message FROM reject_log
WHERE contains(lower(table_name), lower('{SEARCH_TERM}')) OR contains(lower(error_message), lower('{SEARCH_TERM}'))
   OR contains(lower(record_id), lower('{SEARCH_TERM}'))""",
    ids=("F17",),
)
def log_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.log_search(reject_log(spark, sf_dir), SEARCH_TERM).select("id", "table_name", "error_message")


@register(
    "log_summary",
    oracle=REJECT_LOG_SQL
    + """SELECT 'table' AS level, table_name AS value, COUNT(*) AS n FROM reject_log GROUP BY table_name
UNION ALL SELECT 'error_type', error_type, COUNT(*) FROM reject_log GROUP BY error_type
UNION ALL SELECT 'total', '', COUNT(*) FROM reject_log""",
    ids=("A9", "A10"),
)
def log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.log_summary(reject_log(spark, sf_dir))


@register(
    "log_date_rollup",
    oracle=REJECT_LOG_SQL
    + """SELECT CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
       CAST(day("timestamp") AS INTEGER) AS day, COUNT(*) AS n
FROM reject_log GROUP BY ROLLUP (year("timestamp"), month("timestamp"), day("timestamp"))""",
    ids=("A11",),
)
def log_date_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.log_date_rollup(reject_log(spark, sf_dir))


@register(
    "latest_logs",
    oracle=REJECT_LOG_SQL
    + f"""SELECT id, "timestamp", table_name, error_type FROM reject_log
ORDER BY "timestamp" DESC, id DESC LIMIT {specs.LOG_LIMIT}""",
    ids=("O3", "O4"),
)
def latest_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.latest(reject_log(spark, sf_dir), specs.LOG_LIMIT).select("id", "timestamp", "table_name", "error_type")


@register(
    "shorten_message",
    oracle=REJECT_LOG_SQL
    + """SELECT id, CASE WHEN length(error_message) > 100 THEN substring(error_message, 1, 100) || '...'
                ELSE error_message END AS message_short FROM reject_log""",
    ids=("E14",),
)
def shorten_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.with_display(reject_log(spark, sf_dir)).select("id", "message_short")


@register(
    "severity_map",
    oracle=REJECT_LOG_SQL
    + """SELECT id, error_type, CASE error_type WHEN 'VALIDATION_ERROR' THEN 'ERROR'
       WHEN 'MISSING_REQUIRED_FIELDS' THEN 'WARNING' WHEN 'BATCH_SUMMARY' THEN 'SUCCESS' ELSE 'WARNING' END AS severity
FROM reject_log""",
    ids=("E15",),
)
def severity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.with_display(reject_log(spark, sf_dir)).select("id", "error_type", "severity")


@register(
    "audit_filter",
    oracle=AUDIT_SQL
    + f"""SELECT event_id, "timestamp", event_type, api_key_name, endpoint, method,
       CASE event_type WHEN 'AUTH_SUCCESS' THEN 'green' WHEN 'AUTH_FAILED' THEN 'red' WHEN 'AUTH_MISSING' THEN 'orange'
         WHEN 'AUTH_INVALID' THEN 'red' WHEN 'AUTH_EXPIRED' THEN 'orange' WHEN 'RATE_LIMIT' THEN 'red'
         WHEN 'INVALID_INPUT' THEN 'orange' WHEN 'UNAUTHORIZED_ACCESS' THEN 'red' ELSE 'black' END AS colour
FROM audit WHERE event_type = 'RATE_LIMIT' ORDER BY "timestamp" DESC, event_id DESC LIMIT {specs.AUDIT_LIMIT}""",
    ids=("F16", "O3", "E15"),
)
def audit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = fixtures.raw_audit(spark, sf_dir).where(F.col("event_type") == "RATE_LIMIT")
    top = rejects.latest(audit, specs.AUDIT_LIMIT, ts="timestamp", tie="event_id")
    return top.select(
        "event_id", "timestamp", "event_type", "api_key_name", "endpoint", "method",
        event_colour("event_type").alias("colour"),
    )


_PATTERNS_SQL = " OR ".join(f"regexp_matches(lower(user_agent), '{p}')" for p in specs.SUSPICIOUS_AGENT_PATTERNS)


@register(
    "flag_text_patterns",
    oracle=AUDIT_SQL + f"SELECT event_id, user_agent, coalesce({_PATTERNS_SQL}, false) AS suspicious FROM audit",
    ids=("F18", "E4"),
)
def flag_text_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = fixtures.raw_audit(spark, sf_dir)
    return audit.select("event_id", "user_agent", matches_any("user_agent").alias("suspicious"))


@register(
    "hash_column",
    oracle=AUDIT_SQL + "SELECT event_id, sha256(api_key_name) AS api_key_hash FROM audit",
    ids=("E16",),
)
def hash_column_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = fixtures.raw_audit(spark, sf_dir)
    return audit.select("event_id", hash_column("api_key_name").alias("api_key_hash"))


def _sanitize_sql(col: str) -> str:
    return f"""regexp_replace(
         regexp_replace(
           regexp_replace(
             regexp_replace(
               substring(regexp_replace({col}, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g'), 1, {specs.SANITIZE_MAX_CHARS}),
               '(?is)<script[^>]*>.*?</script>', '', 'g'),
             '(?i)javascript:', '', 'g'),
           '(?i)vbscript:', '', 'g'),
         '^\\s+|\\s+$', '', 'g')"""


_SANITIZE_SQL = f"SELECT page_id, {_sanitize_sql('html')} AS html_clean FROM pages"


@register("sanitize_text", oracle=_SANITIZE_SQL, ids=("E12",))
def sanitize_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", sanitize_text("html").alias("html_clean"))


@register(
    "sanitize_nested",
    oracle=f"""SELECT page_id, {_sanitize_sql('url')} AS url, {_sanitize_sql('html')} AS part0,
       {_sanitize_sql('url')} AS part1, {_sanitize_sql('html')} AS field_html FROM pages""",
    ids=("E13",),
)
def sanitize_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages"))
    nested = pages.select(
        "page_id",
        F.struct(F.col("url").alias("url"), F.array(F.col("html"), F.col("url")).alias("parts")).alias("doc"),
        F.create_map(F.lit("html"), F.col("html")).alias("fields"),
    )
    clean = map_all_strings(nested, sanitize_text)
    # the nested values, sanitised in place, read back out as columns
    return clean.select(
        "page_id",
        F.col("doc.url").alias("url"),
        F.col("doc.parts").getItem(0).alias("part0"),
        F.col("doc.parts").getItem(1).alias("part1"),
        F.col("fields").getItem("html").alias("field_html"),
    )


BURST_LIMIT = 3
BURST_TTL_SECONDS = 6 * 3600


def _burst_oracle() -> str:
    ttl_us = BURST_TTL_SECONDS * 1_000_000
    return f"""
WITH RECURSIVE e AS (
  SELECT user_id, event_id, epoch_us(ts) AS t,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) AS rn
  FROM events
),
sim(user_id, rn, event_id, cnt, expires, flagged) AS (
  SELECT user_id, rn, event_id, 1, t + {ttl_us}, false FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn, e.event_id,
         CASE WHEN (CASE WHEN e.t >= s.expires THEN 0 ELSE s.cnt END) >= {BURST_LIMIT}
              THEN s.cnt ELSE (CASE WHEN e.t >= s.expires THEN 0 ELSE s.cnt END) + 1 END,
         CASE WHEN (CASE WHEN e.t >= s.expires THEN 0 ELSE s.cnt END) >= {BURST_LIMIT}
              THEN s.expires ELSE e.t + {ttl_us} END,
         (CASE WHEN e.t >= s.expires THEN 0 ELSE s.cnt END) >= {BURST_LIMIT}
  FROM sim s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1
)
SELECT user_id, event_id, flagged FROM sim
"""


@register("burst_flags", oracle=_burst_oracle(), ids=("T8",))
def burst_flags_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starload.operators.burst import burst_flags

    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    out = burst_flags(events, key="user_id", ts="ts", tie="event_id", limit=BURST_LIMIT, ttl_seconds=BURST_TTL_SECONDS)
    return out.select("user_id", "event_id", "flagged")


@register(
    "json_records",
    oracle="""SELECT event_id, '{"event_id":' || CAST(event_id AS VARCHAR) || ',"ts":' || coalesce('"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"', 'null')
       || ',"user_id":' || coalesce(CAST(user_id AS VARCHAR), 'null') || ',"ratio":'
       || CASE WHEN event_id % 5 = 0 THEN 'null' ELSE CAST(event_id % 4 AS VARCHAR) || '.5' END || '}' AS record
FROM events""",
    ids=("E10",),
)
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as JSON for a log: ISO timestamps, no NaN (every fifth ratio is one)."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    ratio = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("event_id") % 4 + F.lit(0.5))
    rows = events.withColumn("ratio", nan_to_null(ratio))
    return rows.select("event_id", json_record("event_id", "ts", "user_id", "ratio").alias("record"))


@register(
    "format_error",
    oracle="""SELECT event_id, CASE WHEN event_id % 3 = 2 THEN '[user ' || CAST(user_id AS VARCHAR) || '] ' ELSE '' END || event_type || ': ' || props AS message FROM events""",
    ids=("E17",),
)
def format_error_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages for a log; every third has a context, the others an empty one or none."""
    context = F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 2, F.concat(F.lit("user "), F.col("user_id").cast("string")))
    events = table(spark, sf_dir, "events").withColumn("context", context)
    return events.select("event_id", format_error("event_type", "props", "context").alias("message"))
