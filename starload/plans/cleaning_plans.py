"""Cleaning queries (F1–F9, A8) on the dirty fact and dimension fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload import specs
from starload.operators import cleaning
from starload.plans import fixtures
from starload.plans.registry import register

_TOKENS = ", ".join(f"'{t}'" for t in specs.NULL_TOKENS)
_NUM = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Independent DuckDB form of the fact cleaner: token nulls, first failing step, keep-first.
HIRES_STEPS_SQL = f"""
WITH raw AS ({fixtures.select_sql(fixtures.RAW_HIRES, "lineitem")}),
t AS (
  SELECT _pos, _tie,
         CASE WHEN id IN ({_TOKENS}) THEN NULL ELSE id END AS id,
         CASE WHEN name IN ({_TOKENS}) THEN NULL ELSE name END AS name,
         CASE WHEN datetime IN ({_TOKENS}) THEN NULL ELSE datetime END AS datetime,
         CASE WHEN department_id IN ({_TOKENS}) THEN NULL ELSE department_id END AS department_id,
         CASE WHEN job_id IN ({_TOKENS}) THEN NULL ELSE job_id END AS job_id
  FROM raw
),
a AS (
  SELECT *, trim(name) AS name_s, TRY_CAST(datetime AS TIMESTAMP) AS ts,
         trim(department_id) AS d_s, trim(job_id) AS j_s, trim(id) AS id_s
  FROM t
),
b AS (
  SELECT *,
         CASE WHEN regexp_matches(d_s, '{_NUM}') THEN TRY_CAST(d_s AS DOUBLE) END AS d_dbl,
         CASE WHEN regexp_matches(j_s, '{_NUM}') THEN TRY_CAST(j_s AS DOUBLE) END AS j_dbl
  FROM a
),
c AS (
  SELECT *,
         CASE WHEN abs(d_dbl) < 2147483648 THEN CAST(trunc(d_dbl) AS INTEGER) END AS d_int,
         CASE WHEN abs(j_dbl) < 2147483648 THEN CAST(trunc(j_dbl) AS INTEGER) END AS j_int,
         CASE WHEN regexp_matches(id_s, '^[+-]?[0-9]+$') AND abs(TRY_CAST(id_s AS HUGEINT)) <= 2147483647
              THEN CAST(id_s AS INTEGER) END AS id_int
  FROM b
),
s AS (
  SELECT *, CASE
      WHEN id IS NULL OR name IS NULL OR datetime IS NULL OR department_id IS NULL OR job_id IS NULL THEN 'required'
      WHEN name_s = '' THEN 'name_blank'
      WHEN lower(name_s) IN ('nan', 'none', 'null', '') THEN 'name_token'
      WHEN ts IS NULL THEN 'timestamp'
      WHEN d_s IN ({_TOKENS}) OR j_s IN ({_TOKENS}) THEN 'fk_token'
      WHEN d_int IS NULL OR j_int IS NULL THEN 'fk_not_numeric'
      WHEN d_int <= 0 OR j_int <= 0 THEN 'fk_not_positive'
      WHEN id_int IS NULL THEN 'bad_id'
    END AS step
  FROM c
),
d AS (
  SELECT *, CASE WHEN step IS NULL AND
                      ROW_NUMBER() OVER (PARTITION BY id_int, step IS NULL ORDER BY _pos, _tie) > 1
                 THEN 'duplicate' ELSE step END AS final_step
  FROM s
)
"""

def dim_steps_sql(columns: dict[str, str], source: str) -> str:
    """Independent DuckDB form of the dimension cleaner over a fixture."""
    return f"""
WITH raw AS ({fixtures.select_sql(columns, source)}),
t AS (
  SELECT _pos,
         CASE WHEN id IN ({_TOKENS}) THEN NULL ELSE id END AS id,
         CASE WHEN name IN ({_TOKENS}) THEN NULL ELSE name END AS name
  FROM raw
),
c AS (
  SELECT *, trim(name) AS name_s,
         CASE WHEN regexp_matches(trim(id), '^[+-]?[0-9]+$') AND abs(TRY_CAST(trim(id) AS HUGEINT)) <= 2147483647
              THEN CAST(trim(id) AS INTEGER) END AS id_int
  FROM t
),
s AS (
  SELECT *, CASE
      WHEN id IS NULL OR name IS NULL THEN 'required'
      WHEN name_s = '' THEN 'name_blank'
      WHEN id_int IS NULL THEN 'bad_id'
    END AS step
  FROM c
),
d AS (
  SELECT *, CASE WHEN step IS NULL AND
                      ROW_NUMBER() OVER (PARTITION BY id_int, step IS NULL ORDER BY _pos) > 1
                 THEN 'duplicate' ELSE step END AS final_step
  FROM s
)
"""


DIM_STEPS_SQL = dim_steps_sql(fixtures.RAW_DEPARTMENTS, "supplier")


def _hires(spark: SparkSession, sf_dir: str) -> cleaning.CleanResult:
    return cleaning.clean(fixtures.raw_hires(spark, sf_dir), specs.HIRED_EMPLOYEES, position=fixtures.HIRES_POSITION)


@register(
    "clean_null_tokens",
    oracle=HIRES_STEPS_SQL + "SELECT _pos, _tie, id, name, datetime, department_id, job_id FROM t",
    ids=("F1",),
)
def clean_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.null_tokens(fixtures.raw_hires(spark, sf_dir), specs.HIRED_EMPLOYEES.columns)


@register(
    "clean_required",
    oracle=HIRES_STEPS_SQL + "SELECT _pos, _tie FROM s WHERE step IS NULL OR step <> 'required'",
    ids=("F2", "F3"),
)
def clean_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    ann = cleaning.annotate(fixtures.raw_hires(spark, sf_dir), specs.HIRED_EMPLOYEES, position=fixtures.HIRES_POSITION)
    return cleaning.survivors(ann, specs.HIRED_EMPLOYEES, "required").select("_pos", "_tie")


@register(
    "clean_names",
    oracle=HIRES_STEPS_SQL
    + "SELECT _pos, _tie, name_s AS name FROM s WHERE step IS NULL OR step NOT IN ('required', 'name_blank', 'name_token')",
    ids=("F4",),
)
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ann = cleaning.annotate(fixtures.raw_hires(spark, sf_dir), specs.HIRED_EMPLOYEES, position=fixtures.HIRES_POSITION)
    return cleaning.survivors(ann, specs.HIRED_EMPLOYEES, "name_token").select("_pos", "_tie", "name")


@register(
    "clean_timestamps",
    oracle=HIRES_STEPS_SQL
    + "SELECT _pos, _tie, ts AS datetime FROM s WHERE step IS NULL OR step NOT IN ('required', 'name_blank', 'name_token', 'timestamp')",
    ids=("F5", "E5"),
)
def clean_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ann = cleaning.annotate(fixtures.raw_hires(spark, sf_dir), specs.HIRED_EMPLOYEES, position=fixtures.HIRES_POSITION)
    return cleaning.survivors(ann, specs.HIRED_EMPLOYEES, "timestamp").select("_pos", "_tie", "datetime")


_TS_T = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?$"
_TS_S = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"


@register(
    "clean_timestamps_strict",
    oracle=HIRES_STEPS_SQL
    + f"""SELECT _pos, _tie,
       CASE WHEN regexp_matches(datetime, '{_TS_T}') OR regexp_matches(datetime, '{_TS_S}')
            THEN TRY_CAST(replace(datetime, 'T', ' ') AS TIMESTAMP) END AS datetime
FROM s WHERE (step IS NULL OR step NOT IN ('required', 'name_blank', 'name_token'))
  AND (regexp_matches(datetime, '{_TS_T}') OR regexp_matches(datetime, '{_TS_S}'))
  AND TRY_CAST(replace(datetime, 'T', ' ') AS TIMESTAMP) IS NOT NULL""",
    ids=("F5", "E5"),
)
def clean_timestamps_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict mode: only the three zone-less shapes pass (a trailing Z is refused)."""
    ann = cleaning.annotate(
        fixtures.raw_hires(spark, sf_dir), specs.HIRED_EMPLOYEES, position=fixtures.HIRES_POSITION, strict_ts=True
    )
    return cleaning.survivors(ann, specs.HIRED_EMPLOYEES, "timestamp").select("_pos", "_tie", "datetime")


@register(
    "clean_fk_ids",
    oracle=HIRES_STEPS_SQL
    + "SELECT _pos, _tie, d_int AS department_id, j_int AS job_id FROM s WHERE step IS NULL OR step = 'bad_id'",
    ids=("F6", "E8"),
)
def clean_fk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ann = cleaning.annotate(fixtures.raw_hires(spark, sf_dir), specs.HIRED_EMPLOYEES, position=fixtures.HIRES_POSITION)
    return cleaning.survivors(ann, specs.HIRED_EMPLOYEES, "fk_not_positive").select("_pos", "_tie", "department_id", "job_id")


@register(
    "dedup_keep_first",
    oracle=HIRES_STEPS_SQL
    + "SELECT _pos, _tie, id_int AS id, name_s AS name, ts AS datetime, d_int AS department_id, j_int AS job_id "
    "FROM d WHERE final_step IS NULL",
    ids=("F9", "L3"),
)
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hires(spark, sf_dir).kept


@register(
    "clean_dim",
    oracle=DIM_STEPS_SQL + "SELECT _pos, id_int AS id, name_s AS name FROM d WHERE final_step IS NULL",
    ids=("F7", "F9"),
)
def clean_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(fixtures.raw_departments(spark, sf_dir), specs.DEPARTMENTS).kept


_STATS_SQL = (
    HIRES_STEPS_SQL
    + """,
steps(step_no, step) AS (VALUES """
    + ", ".join(f"({i + 1}, '{s}')" for i, s in enumerate(cleaning.FACT_STEPS))
    + """),
counts AS (SELECT final_step AS step, COUNT(*) AS removed FROM d WHERE final_step IS NOT NULL GROUP BY final_step),
total AS (SELECT COUNT(*) AS n FROM d),
j AS (SELECT steps.step_no, steps.step, CAST(COALESCE(counts.removed, 0) AS BIGINT) AS removed
      FROM steps LEFT JOIN counts ON steps.step = counts.step)
SELECT j.step_no, j.step, j.removed,
       CAST(total.n - SUM(j.removed) OVER (ORDER BY j.step_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS rows_left,
       CASE WHEN total.n > 0 THEN round(j.removed * 100.0 / total.n, 2) ELSE 0.0 END AS pct_removed
FROM j, total
"""
)


@register("clean_stats", oracle=_STATS_SQL, ids=("A8", "E9"))
def clean_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_stats(_hires(spark, sf_dir).annotated, specs.HIRED_EMPLOYEES)

