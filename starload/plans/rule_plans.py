"""Validation queries (V1–V12, F11–F13, S14, A6, A7, L8) on the message stream fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.operators import ingest, rejects
from starload.plans import fixtures
from starload.plans.registry import register
from starload.plans.tables import table
from starload.session import scratch_path
from starload.sources.envelope import parse_envelope


def dims_and_targets(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Stored tables of the star analogue: departments ← supplier, jobs ← part, and the fact's
    stored ids ← orders."""
    departments = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    jobs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    fact_ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    dims = {"departments": departments, "jobs": jobs}
    targets = {"departments": departments, "jobs": jobs, "hired_employees": fact_ids}
    return dims, targets


def checked_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims, targets = dims_and_targets(spark, sf_dir)
    return ingest.check_messages(fixtures.raw_messages(spark, sf_dir), dims=dims, targets=targets, as_of=fixtures.AS_OF)


def reject_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = checked_messages(spark, sf_dir)
    return rejects.reject_rows(
        checked,
        log_id=F.col("_offset"),
        timestamp=F.col("arrived"),
        record_id=ingest.record_index(F.col("_offset")),
    )


# ------------------------------------------------------------------------------------------
# DuckDB oracle: the same rules written against DuckDB's JSON functions.
# ------------------------------------------------------------------------------------------


def _t(f: str) -> str:
    return f"json_type(pl, '$.{f}')"


def _falsy(f: str) -> str:
    t = _t(f)
    return f"""({t} IS NULL OR {t} = 'NULL'
      OR ({t} = 'VARCHAR' AND trim(json_extract_string(pl, '$.{f}')) = '')
      OR ({t} IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND TRY_CAST(json_extract(pl, '$.{f}') AS DOUBLE) = 0)
      OR ({t} = 'BOOLEAN' AND NOT TRY_CAST(json_extract(pl, '$.{f}') AS BOOLEAN))
      OR ({t} = 'ARRAY' AND json_array_length(pl, '$.{f}') = 0)
      OR ({t} = 'OBJECT' AND CAST(json_extract(pl, '$.{f}') AS VARCHAR) = '{{}}'))"""


def _int(f: str) -> str:
    t = _t(f)
    s = f"json_extract_string(pl, '$.{f}')"
    return f"""(CASE WHEN {t} IN ('BIGINT', 'UBIGINT') THEN TRY_CAST(json_extract(pl, '$.{f}') AS BIGINT)
      WHEN {t} = 'DOUBLE' THEN TRY_CAST(trunc(TRY_CAST(json_extract(pl, '$.{f}') AS DOUBLE)) AS BIGINT)
      WHEN {t} = 'BOOLEAN' THEN CASE WHEN TRY_CAST(json_extract(pl, '$.{f}') AS BOOLEAN) THEN 1 ELSE 0 END
      WHEN {t} = 'VARCHAR' AND regexp_matches({s}, '^\\s*[+-]?[0-9]+\\s*$') THEN TRY_CAST(trim({s}) AS BIGINT)
    END)"""


_TS_T = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?$"
_TS_S = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
_CHARSET = r"^[a-zA-ZáéíóúÁÉÍÓÚñÑ\s\-\.]+$"

CHECKED_SQL = f"""
WITH m AS ({fixtures.select_sql(fixtures.RAW_MESSAGES, "events")}),
e AS (
  SELECT m.*, CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT' THEN
           list_sort(json_keys(value)) = ['payload', 'table']
           AND json_type(value, '$.table') = 'VARCHAR' AND json_type(value, '$.payload') = 'OBJECT'
         ELSE false END AS envelope_ok
  FROM m
),
p AS (
  SELECT e.*, CASE WHEN envelope_ok THEN json_extract_string(value, '$.table') END AS tbl,
         CASE WHEN envelope_ok THEN json_extract(value, '$.payload') END AS pl
  FROM e
),
r AS (
  SELECT p.*,
    {_falsy('name')} AS f_name, {_falsy('datetime')} AS f_dt,
    {_falsy('department_id')} AS f_dep, {_falsy('job_id')} AS f_job,
    CASE WHEN {_t('name')} = 'VARCHAR' THEN trim(json_extract_string(pl, '$.name'))
         ELSE trim(CAST(json_extract(pl, '$.name') AS VARCHAR)) END AS name_txt,
    {_t('datetime')} AS t_dt,
    json_extract_string(pl, '$.datetime') AS dt_s,
    {_int('department_id')} AS dep_int, {_int('job_id')} AS job_int, {_int('id')} AS id_int,
    {_t('id')} IS NOT NULL AND {_t('id')} <> 'NULL' AS id_present
  FROM p
),
c AS (
  SELECT r.*,
    CASE WHEN t_dt = 'VARCHAR' AND (regexp_matches(dt_s, '{_TS_T}') OR regexp_matches(dt_s, '{_TS_S}'))
         THEN TRY_CAST(replace(dt_s, 'T', ' ') AS TIMESTAMP) END AS ts_val,
    CASE WHEN length(name_txt) < 2 THEN 'NAME_SHORT' WHEN length(name_txt) > 255 THEN 'NAME_LONG'
         WHEN NOT regexp_matches(name_txt, '{_CHARSET}') THEN 'NAME_CHARSET' END AS name_code
  FROM r
),
d AS (
  SELECT c.*,
    CASE WHEN t_dt <> 'VARCHAR' THEN 'TS_TYPE' WHEN ts_val IS NULL THEN 'TS_FORMAT'
         WHEN ts_val > TIMESTAMP '{fixtures.AS_OF}' THEN 'TS_FUTURE' END AS ts_code,
    CASE WHEN dep_int IS NULL THEN 'FK_INTEGER(department_id)' WHEN dep_int <= 0 THEN 'FK_POSITIVE(department_id)'
         WHEN dep_int NOT IN (SELECT s_suppkey FROM supplier) THEN 'FK_MISSING(department_id)' END AS dep_code,
    CASE WHEN job_int IS NULL THEN 'FK_INTEGER(job_id)' WHEN job_int <= 0 THEN 'FK_POSITIVE(job_id)'
         WHEN job_int NOT IN (SELECT p_partkey FROM part) THEN 'FK_MISSING(job_id)' END AS job_code,
    CASE WHEN NOT id_present THEN NULL WHEN id_int IS NULL THEN 'ID_INTEGER'
         WHEN tbl = 'hired_employees' AND (id_int <= 0 OR id_int > 2147483647) THEN 'ID_RANGE'
         WHEN tbl <> 'hired_employees' AND id_int <= 0 THEN 'ID_POSITIVE'
         WHEN tbl = 'hired_employees' AND id_int IN (SELECT o_orderkey FROM orders) THEN 'ID_EXISTS'
         WHEN tbl = 'departments' AND id_int IN (SELECT s_suppkey FROM supplier) THEN 'ID_EXISTS'
         WHEN tbl = 'jobs' AND id_int IN (SELECT p_partkey FROM part) THEN 'ID_EXISTS' END AS id_code
  FROM c
),
k AS (
  SELECT d.*,
    CASE WHEN tbl = 'hired_employees' THEN list_filter([CASE WHEN f_name THEN 'REQUIRED(name)' END,
                                                        CASE WHEN f_dt THEN 'REQUIRED(datetime)' END,
                                                        CASE WHEN f_dep THEN 'REQUIRED(department_id)' END,
                                                        CASE WHEN f_job THEN 'REQUIRED(job_id)' END], lambda x: x IS NOT NULL)
         ELSE list_filter([CASE WHEN f_name THEN 'REQUIRED(name)' END], lambda x: x IS NOT NULL) END AS missing,
    CASE WHEN tbl = 'hired_employees' THEN
           CASE WHEN ts_code IN ('TS_TYPE', 'TS_FORMAT') THEN list_filter([name_code, ts_code], lambda x: x IS NOT NULL)
                ELSE list_filter([name_code, ts_code, dep_code, job_code, id_code], lambda x: x IS NOT NULL) END
         ELSE list_filter([name_code, id_code], lambda x: x IS NOT NULL) END AS codes
  FROM d
),
v AS (
  SELECT k.*,
    CASE WHEN NOT envelope_ok THEN 'INVALID_ENVELOPE'
         WHEN tbl NOT IN ('hired_employees', 'departments', 'jobs') THEN 'UNKNOWN_TABLE'
         WHEN len(missing) > 0 THEN 'MISSING_REQUIRED_FIELDS'
         WHEN len(codes) > 0 THEN 'VALIDATION_ERROR' END AS et0,
    CASE WHEN NOT envelope_ok THEN ['ENVELOPE']
         WHEN tbl NOT IN ('hired_employees', 'departments', 'jobs') THEN ['UNKNOWN_TABLE(' || tbl || ')']
         WHEN len(missing) > 0 THEN missing ELSE codes END AS codes0
  FROM k
),
checked AS (
  SELECT v.*,
    CASE WHEN et0 IS NULL AND id_int IS NOT NULL
              AND ROW_NUMBER() OVER (PARTITION BY batch_id, tbl, id_int, et0 IS NULL AND id_int IS NOT NULL
                                     ORDER BY _offset) > 1
         THEN 'DUPLICATE_IN_BATCH' ELSE et0 END AS error_type,
    CASE WHEN et0 IS NULL AND id_int IS NOT NULL
              AND ROW_NUMBER() OVER (PARTITION BY batch_id, tbl, id_int, et0 IS NULL AND id_int IS NOT NULL
                                     ORDER BY _offset) > 1
         THEN ['DUPLICATE'] ELSE codes0 END AS error_codes
  FROM v
),
final AS (
  SELECT checked.*, CASE WHEN len(error_codes) > 0 THEN array_to_string(error_codes, '; ') END AS error_message
  FROM checked
)
"""


def _codes_like(spark: SparkSession, sf_dir: str, prefixes: tuple[str, ...]) -> DataFrame:
    checked = checked_messages(spark, sf_dir).where(F.col("error_type") == "VALIDATION_ERROR")
    exploded = checked.select("_offset", "table", F.explode("error_codes").alias("code"))
    cond = None
    for p in prefixes:
        c = F.col("code").startswith(p)
        cond = c if cond is None else cond | c
    return exploded.where(cond)


def _codes_sql(prefixes: tuple[str, ...]) -> str:
    cond = " OR ".join(f"starts_with(code, '{p}')" for p in prefixes)
    return (
        CHECKED_SQL
        + f"""SELECT _offset, tbl AS "table", code FROM (
  SELECT _offset, tbl, unnest(error_codes) AS code FROM final WHERE error_type = 'VALIDATION_ERROR'
) WHERE {cond}"""
    )


@register(
    "parse_envelope",
    oracle=CHECKED_SQL + 'SELECT _offset, envelope_ok, tbl AS "table" FROM final',
    ids=("F11", "E11", "S12"),
)
def parse_envelope_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_envelope(fixtures.raw_messages(spark, sf_dir)).select("_offset", "envelope_ok", "table")


@register(
    "rule_required",
    oracle=CHECKED_SQL + "SELECT _offset, tbl AS \"table\", error_message FROM final WHERE error_type = 'MISSING_REQUIRED_FIELDS'",
    ids=("V1", "V13"),
)
def rule_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_messages(spark, sf_dir).where(F.col("error_type") == "MISSING_REQUIRED_FIELDS").select(
        "_offset", "table", "error_message"
    )


@register("rule_name_length", oracle=_codes_sql(("NAME_SHORT", "NAME_LONG")), ids=("V2", "E3"))
def rule_name_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes_like(spark, sf_dir, ("NAME_SHORT", "NAME_LONG"))


@register("rule_name_charset", oracle=_codes_sql(("NAME_CHARSET",)), ids=("V3", "E4"))
def rule_name_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes_like(spark, sf_dir, ("NAME_CHARSET",))


@register("rule_ts_format", oracle=_codes_sql(("TS_FORMAT", "TS_TYPE")), ids=("V4", "V5", "E5"))
def rule_ts_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes_like(spark, sf_dir, ("TS_FORMAT", "TS_TYPE"))


@register("rule_not_future", oracle=_codes_sql(("TS_FUTURE",)), ids=("V6", "E7"))
def rule_not_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes_like(spark, sf_dir, ("TS_FUTURE",))


@register("rule_fk", oracle=_codes_sql(("FK_",)), ids=("V7", "V14", "J4"))
def rule_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes_like(spark, sf_dir, ("FK_",))


@register("rule_id_range", oracle=_codes_sql(("ID_RANGE", "ID_POSITIVE", "ID_INTEGER")), ids=("V8",))
def rule_id_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes_like(spark, sf_dir, ("ID_RANGE", "ID_POSITIVE", "ID_INTEGER"))


@register("rule_id_unused", oracle=_codes_sql(("ID_EXISTS",)), ids=("V9", "J5"))
def rule_id_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes_like(spark, sf_dir, ("ID_EXISTS",))


@register(
    "validate_fact",
    oracle=CHECKED_SQL + "SELECT _offset, error_type, error_message FROM final WHERE tbl = 'hired_employees'",
    ids=("V10",),
)
def validate_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_messages(spark, sf_dir).where(F.col("table") == "hired_employees").select(
        "_offset", "error_type", "error_message"
    )


@register(
    "unknown_table",
    oracle=CHECKED_SQL + "SELECT _offset, tbl AS \"table\", error_message FROM final WHERE error_type = 'UNKNOWN_TABLE'",
    ids=("V11",),
)
def unknown_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_messages(spark, sf_dir).where(F.col("error_type") == "UNKNOWN_TABLE").select(
        "_offset", "table", "error_message"
    )


@register(
    "split_accept_reject",
    oracle=CHECKED_SQL
    + """SELECT _offset, tbl AS "table", CASE WHEN error_type IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
       error_type, CAST(_offset % 1000 AS VARCHAR) AS record_id FROM final""",
    ids=("V12", "T7"),
)
def split_accept_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = checked_messages(spark, sf_dir)
    return checked.select(
        "_offset",
        "table",
        F.when(F.col("error_type").isNull(), F.lit("accepted")).otherwise(F.lit("rejected")).alias("status"),
        "error_type",
        ingest.record_index(F.col("_offset")).alias("record_id"),
    )


@register(
    "reject_log",
    oracle=CHECKED_SQL
    + """SELECT _offset AS id, arrived AS "timestamp", coalesce(tbl, '') AS table_name,
       CAST(_offset % 1000 AS VARCHAR) AS record_id, error_type, error_message
FROM final WHERE error_type IS NOT NULL""",
    ids=("S14",),
)
def reject_log_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_log(spark, sf_dir).drop("raw_data")


@register(
    "batch_summary",
    oracle=CHECKED_SQL
    + """SELECT tbl AS "table", batch_id, 'BATCH_SUMMARY' AS error_type, total_records, valid_records, failed_records,
       CASE WHEN total_records > 0 THEN round(valid_records * 100.0 / total_records, 2) ELSE 0.0 END AS success_rate,
       format('batch processed: {}/{} records valid, {} failed validation', valid_records, total_records, failed_records)
         AS error_message
FROM (SELECT tbl, batch_id, COUNT(*) AS total_records,
             COUNT(*) FILTER (WHERE error_type IS NULL) AS valid_records,
             COUNT(*) FILTER (WHERE error_type IS NOT NULL) AS failed_records
      FROM final GROUP BY tbl, batch_id)
WHERE failed_records > 0""",
    ids=("A6", "E9"),
)
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.batch_summary(checked_messages(spark, sf_dir))


@register(
    "batch_transaction",
    oracle=CHECKED_SQL
    + """SELECT tbl AS "table", batch_id, COUNT(*) FILTER (WHERE error_type IS NULL) AS accepted,
       COUNT(*) FILTER (WHERE error_type IS NOT NULL) AS rejected,
       CASE WHEN COUNT(*) FILTER (WHERE error_type IS NULL) > 0 THEN 202 ELSE 400 END AS status
FROM final GROUP BY tbl, batch_id""",
    ids=("L8", "A7"),
)
def batch_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.batch_reply(checked_messages(spark, sf_dir))


@register(
    "batch_contract",
    oracle=CHECKED_SQL
    + """SELECT tbl AS "table", batch_id, COUNT(*) AS n_records,
       coalesce(tbl IN ('hired_employees', 'departments', 'jobs'), false) AND COUNT(*) BETWEEN 1 AND 1000 AS contract_ok
FROM final GROUP BY tbl, batch_id""",
    ids=("F12",),
)
def batch_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = parse_envelope(fixtures.raw_messages(spark, sf_dir))
    return rejects.batch_contract(env)


# calls of 1500 records (refused), then of 700
_CALL_SQL = f"CASE WHEN {fixtures.RAW_MESSAGES['_offset']} < 3000 THEN CAST(floor({fixtures.RAW_MESSAGES['_offset']} / 1500) AS BIGINT) ELSE 10 + CAST(floor({fixtures.RAW_MESSAGES['_offset']} / 700) AS BIGINT) END"


@register(
    "batch_call",
    oracle=CHECKED_SQL.replace(fixtures.RAW_MESSAGES["batch_id"], _CALL_SQL)
    + """SELECT batch_id, CASE WHEN n > 1000 THEN 0 ELSE ok END AS accepted, CASE WHEN n > 1000 THEN n ELSE n - ok END AS rejected,
       CASE WHEN n > 1000 OR ok = 0 THEN 400 ELSE 202 END AS status, CASE WHEN n > 1000 THEN 'BATCH_SIZE' ELSE coalesce(errors, '') END AS errors,
       CASE WHEN n > 1000 THEN 0 ELSE ok END AS inserted
FROM (SELECT batch_id, count(*) AS n, count(*) FILTER (error_type IS NULL) AS ok,
             string_agg(CAST(_offset % 1000 AS VARCHAR) || ' ' || error_message, '|' ORDER BY _offset % 1000, error_message)
               FILTER (error_type IS NOT NULL) AS errors
      FROM final GROUP BY batch_id)""",
    ids=("L8", "F12", "A7"),
)
def batch_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch calls end to end: the contract refuses calls of more than 1000 records, the rest are checked, accepted
    records are written, and each call gets its counts, status and list of errors."""
    dims, targets = dims_and_targets(spark, sf_dir)
    messages = fixtures.raw_messages(spark, sf_dir)
    number = F.col("_offset")
    call = F.when(number < 3000, F.floor(number / 1500)).otherwise(10 + F.floor(number / 700)).cast("bigint")
    called = rejects.enforce_contract(messages.withColumn("batch_id", call))
    checked = ingest.check_messages(called.where("contract_ok"), dims=dims, targets=targets, as_of=fixtures.AS_OF)
    checked = checked.withColumn("record_id", ingest.record_index(F.col("_offset")))
    path = scratch_path(spark, "batch-call")
    checked.where(F.col("error_type").isNull()).select("batch_id", "_offset").write.parquet(path)
    inserted = spark.read.parquet(path).groupBy(F.col("batch_id").alias("_call")).agg(F.count(F.lit(1)).alias("inserted"))
    replies = rejects.call_reply(checked).unionByName(rejects.refused_reply(called.where("not contract_ok")))
    text = F.array_join(F.transform("errors", lambda e: F.concat_ws(" ", e["record"].cast("string"), e["error"])), "|")
    out = replies.join(inserted, F.col("batch_id") == F.col("_call"), "left")
    return out.select("batch_id", "accepted", "rejected", "status", text.alias("errors"), F.coalesce("inserted", F.lit(0)).alias("inserted"))


@register(
    "route_by_id",
    oracle=CHECKED_SQL
    + """SELECT _offset, CASE WHEN id_present THEN 'with_id' ELSE 'without_id' END AS route
FROM final WHERE error_type IS NULL AND tbl = 'hired_employees'""",
    ids=("F13", "T4"),
)
def route_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starload.operators.loading import route_by_id as route

    accepted = checked_messages(spark, sf_dir).where(F.col("error_type").isNull() & (F.col("table") == "hired_employees"))
    with_id, without_id = route(accepted)
    return with_id.select("_offset", F.lit("with_id").alias("route")).unionByName(
        without_id.select("_offset", F.lit("without_id").alias("route"))
    )
