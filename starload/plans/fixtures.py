"""Dirty inputs derived from the given tables by deterministic SQL expressions.

The same expression text runs in Spark (``selectExpr``) and in DuckDB (the oracle's CTE), so
both engines start from identical raw strings; what each then does with them is written
independently. Every derived table grows with the table it comes from.

Star analogue: fact ``hired_employees`` ← lineitem (id = l_orderkey, repeated across line
numbers, so keep-first de-duplication has work), ``departments`` ← supplier, ``jobs`` ← part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.operators.partitioning import spread
from starload.plans.tables import table

HIRES_POSITION = ("_pos", "_tie")

# position of a lineitem row: unique and stable (order key, then line number)
_K = "(l_orderkey * 8 + l_linenumber)"
_LETTERS = "translate(CAST(l_partkey AS STRING), '0123456789', 'abcdefghij')"
_TS_T = "replace(CAST(l_shipdate AS STRING), ' ', 'T')"

RAW_HIRES = {
    "_pos": f"{_K}",
    # (order key, line number) repeats in this data; the tie-break makes the position total
    "_tie": "CAST(l_partkey AS STRING) || ':' || CAST(l_suppkey AS STRING) || ':' || CAST(l_shipdate AS STRING)",
    "id": f"""CASE {_K} % 211
        WHEN 17 THEN 'x' || CAST(l_orderkey AS STRING)
        WHEN 18 THEN 'NULL'
        WHEN 19 THEN ' ' || CAST(l_orderkey AS STRING) || ' '
        WHEN 20 THEN CAST(l_orderkey AS STRING) || '.5'
        ELSE CAST(l_orderkey AS STRING) END""",
    "name": f"""CASE {_K} % 53
        WHEN 0 THEN 'NULL'
        WHEN 1 THEN ''
        WHEN 2 THEN '   '
        WHEN 3 THEN 'nUlL'
        WHEN 4 THEN 'None'
        WHEN 5 THEN '  Nan  '
        WHEN 6 THEN '  Emp ' || {_LETTERS} || ' '
        WHEN 7 THEN 'none'
        WHEN 8 THEN 'C3PO'
        ELSE 'Emp ' || {_LETTERS} END""",
    "datetime": f"""CASE {_K} % 47
        WHEN 0 THEN 'oops'
        WHEN 1 THEN '2021-02-30T00:00:00'
        WHEN 2 THEN {_TS_T} || 'Z'
        WHEN 3 THEN 'nan'
        WHEN 4 THEN CAST(l_shipdate AS STRING)
        ELSE {_TS_T} END""",
    "department_id": """CASE (l_orderkey * 8 + l_linenumber) % 59
        WHEN 0 THEN 'x'
        WHEN 1 THEN CAST(l_suppkey AS STRING) || '.9'
        WHEN 2 THEN '0.5'
        WHEN 3 THEN '-3'
        WHEN 4 THEN '3000000000'
        WHEN 5 THEN '12d'
        WHEN 6 THEN ' NULL '
        WHEN 7 THEN ' ' || CAST(l_suppkey AS STRING) || ' '
        WHEN 8 THEN '1e1'
        ELSE CAST(l_suppkey AS STRING) END""",
    "job_id": """CASE (l_orderkey * 8 + l_linenumber) % 61
        WHEN 0 THEN 'abc'
        WHEN 1 THEN ''
        WHEN 2 THEN '+' || CAST(l_partkey AS STRING)
        WHEN 3 THEN '.5'
        WHEN 4 THEN 'NaN'
        ELSE CAST(l_partkey AS STRING) END""",
}

# departments ← supplier: two rows per id (keep-first has work), some broken ids and names
RAW_DEPARTMENTS = {
    "_pos": "s_suppkey",
    "id": """CASE s_suppkey % 17
        WHEN 0 THEN 'NULL'
        WHEN 1 THEN 'x'
        WHEN 2 THEN '1.5'
        WHEN 3 THEN ' ' || CAST(CAST(floor(s_suppkey / 2) AS BIGINT) AS STRING) || ' '
        ELSE CAST(CAST(floor(s_suppkey / 2) AS BIGINT) AS STRING) END""",
    "name": """CASE s_suppkey % 13
        WHEN 0 THEN ''
        WHEN 1 THEN '   '
        WHEN 2 THEN ' null '
        WHEN 3 THEN 'None'
        ELSE s_name END""",
}


# jobs ← part: one row per part, names repeat (brands)
RAW_JOBS = {
    "_pos": "p_partkey",
    "id": "CAST(p_partkey AS STRING)",
    "name": "p_brand",
}


def select_sql(columns: dict[str, str], source: str) -> str:
    """The fixture as a SQL SELECT (DuckDB side)."""
    body = ",\n       ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return f"SELECT {body}\nFROM {source}"


def _derive(spark: SparkSession, sf_dir: str, source: str, columns: dict[str, str]) -> DataFrame:
    derived = table(spark, sf_dir, source).selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])
    return spread(derived)


def raw_hires(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "lineitem", RAW_HIRES)


def raw_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "supplier", RAW_DEPARTMENTS)


def raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "part", RAW_JOBS)


# ---------------------------------------------------------------------------------------------
# Message stream ← events: one envelope per event, in event_id order, 1000 messages per batch.
# The payload varies with event_id so that every rule fires; ids and keys come from the data.
# ---------------------------------------------------------------------------------------------
_N = "event_id"
_U = "CAST(user_id AS STRING)"
_TS_SEC = "CAST(date_trunc('second', ts) AS STRING)"
_TABLE = f"""CASE WHEN {_N} % 50 = 7 THEN 'zzz'
        WHEN {_N} % 10 = 1 THEN 'departments'
        WHEN {_N} % 10 = 2 THEN 'jobs'
        ELSE 'hired_employees' END"""
_FACT_ID = f"""CASE {_N} % 23
        WHEN 0 THEN '"id":0,'
        WHEN 1 THEN '"id":2147483648,'
        WHEN 2 THEN '"id":"x",'
        WHEN 3 THEN '"id":null,'
        WHEN 4 THEN ''
        WHEN 5 THEN '"id":' || CAST(user_id * 10 AS STRING) || ','
        WHEN 6 THEN '"id":"' || CAST({_N} + 20000000 AS STRING) || '",'
        ELSE '"id":' || CAST({_N} + 20000000 AS STRING) || ',' END"""
_DIM_ID = f"""CASE {_N} % 7
        WHEN 0 THEN ''
        WHEN 1 THEN '"id":0,'
        WHEN 2 THEN '"id":"x",'
        WHEN 3 THEN '"id":' || {_U} || ','
        WHEN 4 THEN '"id":-1,'
        ELSE '"id":' || CAST({_N} + 20000000 AS STRING) || ',' END"""
_NAME = f"""CASE {_N} % 19
        WHEN 0 THEN '"name":"A",'
        WHEN 1 THEN '"name":"  ",'
        WHEN 2 THEN '"name":"Ana3",'
        WHEN 3 THEN '"name":"' || repeat('a', 256) || '",'
        WHEN 4 THEN ''
        WHEN 5 THEN '"name":0,'
        WHEN 6 THEN '"name":"Ana-M. Gil",'
        WHEN 7 THEN '"name":"Üna",'
        WHEN 8 THEN '"name":"Ana Ñu",'
        WHEN 9 THEN '"name":true,'
        WHEN 10 THEN '"name":"' || repeat('b', 255) || '",'
        ELSE '"name":"Emp ' || translate({_U}, '0123456789', 'abcdefghij') || '",' END"""
_DATETIME = f"""CASE {_N} % 17
        WHEN 0 THEN '"datetime":"bad",'
        WHEN 1 THEN '"datetime":20230101,'
        WHEN 2 THEN '"datetime":"2026-01-01T00:00:00",'
        WHEN 3 THEN '"datetime":"' || replace({_TS_SEC}, ' ', 'T') || 'Z",'
        WHEN 4 THEN '"datetime":"2023-01-01T10:00:00.5",'
        WHEN 5 THEN '"datetime":"' || {_TS_SEC} || '",'
        WHEN 6 THEN ''
        WHEN 7 THEN '"datetime":"2023-02-30T10:00:00",'
        ELSE '"datetime":"' || replace({_TS_SEC}, ' ', 'T') || '",' END"""
_DEPT = f"""CASE {_N} % 13
        WHEN 0 THEN '"department_id":0,'
        WHEN 1 THEN '"department_id":"0",'
        WHEN 2 THEN '"department_id":" 2 ",'
        WHEN 3 THEN '"department_id":1.7,'
        WHEN 4 THEN '"department_id":"1.7",'
        WHEN 5 THEN '"department_id":true,'
        WHEN 6 THEN ''
        WHEN 7 THEN '"department_id":[],'
        WHEN 8 THEN '"department_id":[1],'
        ELSE '"department_id":' || {_U} || ',' END"""
_JOB = f"""CASE {_N} % 11
        WHEN 0 THEN ''
        WHEN 1 THEN '"job_id":-5,'
        WHEN 2 THEN '"job_id":"abc",'
        WHEN 3 THEN '"job_id":{{}},'
        ELSE '"job_id":' || CAST(({_N} * 7919) % 2600 AS STRING) || ',' END"""
_PAYLOAD = f"""CASE WHEN {_TABLE} IN ('departments', 'jobs')
        THEN '{{' || {_DIM_ID} || {_NAME} || '"src":"ev"}}'
        ELSE '{{' || {_FACT_ID} || {_NAME} || {_DATETIME} || {_DEPT} || {_JOB} || '"src":"ev"}}' END"""

RAW_MESSAGES = {
    "_offset": _N,
    "batch_id": f"CAST(floor({_N} / 1000) AS BIGINT)",
    "arrived": "ts",
    "value": f"""CASE {_N} % 97
        WHEN 3 THEN 'not json'
        WHEN 4 THEN '{{"table":"jobs"}}'
        WHEN 5 THEN '{{"table":"jobs","payload":[1,2]}}'
        WHEN 6 THEN '{{"table":"jobs","payload":{{"id":1,"name":"Ab"}},"extra":1}}'
        WHEN 7 THEN '{{"table":5,"payload":{{}}}}'
        ELSE '{{"table":"' || {_TABLE} || '","payload":' || {_PAYLOAD} || '}}' END""",
}

# Validation clock: fixed, so runs and retries agree.
AS_OF = "2025-01-01 00:00:00"


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "events", RAW_MESSAGES)


# ---------------------------------------------------------------------------------------------
# Audit log ← events: one entry per event with an event type, key name, address, agent, method.
# ---------------------------------------------------------------------------------------------
RAW_AUDIT = {
    "event_id": "event_id",
    "timestamp": "ts",
    "event_type": """CASE event_id % 8
        WHEN 0 THEN 'AUTH_SUCCESS'
        WHEN 1 THEN 'AUTH_FAILED'
        WHEN 2 THEN 'AUTH_MISSING'
        WHEN 3 THEN 'AUTH_INVALID'
        WHEN 4 THEN 'AUTH_EXPIRED'
        WHEN 5 THEN 'RATE_LIMIT'
        WHEN 6 THEN 'INVALID_INPUT'
        ELSE 'UNAUTHORIZED_ACCESS' END""",
    "api_key_name": "'key-' || CAST(user_id % 20 AS STRING)",
    "ip_address": "'10.0.' || CAST(user_id % 256 AS STRING) || '.' || CAST(event_id % 256 AS STRING)",
    "user_agent": """CASE event_id % 11
        WHEN 0 THEN 'sqlmap/1.7'
        WHEN 1 THEN 'curl/8.0.1'
        WHEN 2 THEN 'python-requests/2.31'
        WHEN 3 THEN 'Mozilla/5.0 (compatible; Googlebot/2.1)'
        WHEN 4 THEN 'Wget/1.21'
        WHEN 5 THEN 'NMAP Scripting Engine'
        WHEN 6 THEN 'MyCrawler/0.1'
        WHEN 7 THEN 'Nikto'
        ELSE 'Mozilla/5.0 (X11; Linux x86_64) ' || event_type END""",
    "endpoint": "'/api/' || event_type || '/'",
    "method": "CASE WHEN event_id % 3 = 0 THEN 'GET' ELSE 'POST' END",
    "details": "props",
}


def raw_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "events", RAW_AUDIT)
