"""Load queries (L3, L4, L5–L7, O5): conform, id assignment, batches, orphans, full load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload import specs
from starload.operators import loading
from starload.operators.cascade import cascade_replace
from starload.operators.id_leases import IdLeases, assign_leased
from starload.operators.id_store import IdStore
from starload.plans import fixtures
from starload.plans.cleaning_plans import HIRES_STEPS_SQL, _hires, dim_steps_sql
from starload.plans.registry import register
from starload.plans.rule_plans import CHECKED_SQL, checked_messages
from starload.plans.tables import table
from starload.session import scratch_path

_ACCEPTED_FACT_SQL = CHECKED_SQL + """, acc AS (
  SELECT * FROM final WHERE error_type IS NULL AND tbl = 'hired_employees'
)
"""


def accepted_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = checked_messages(spark, sf_dir)
    return checked.where(F.col("error_type").isNull() & (F.col("table") == "hired_employees")).select("_offset", "payload")


@register(
    "conform_fact",
    oracle=_ACCEPTED_FACT_SQL
    + """SELECT _offset, CAST(id_int AS INTEGER) AS id,
       CASE WHEN json_type(pl, '$.name') = 'VARCHAR' THEN json_extract_string(pl, '$.name')
            ELSE CAST(json_extract(pl, '$.name') AS VARCHAR) END AS name,
       date_trunc('second', TRY_CAST(replace(dt_s, 'T', ' ') AS TIMESTAMP)) AS datetime,
       CAST(dep_int AS INTEGER) AS department_id, CAST(job_int AS INTEGER) AS job_id
FROM acc""",
    ids=("L3", "F14", "E6"),
)
def conform_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loading.conform(accepted_facts(spark, sf_dir))


@register(
    "assign_ids",
    oracle=_ACCEPTED_FACT_SQL
    + """SELECT _offset, CAST(CASE WHEN id_int IS NULL THEN
         greatest((SELECT max(o_orderkey) FROM orders), (SELECT max(id_int) FROM acc))
         + ROW_NUMBER() OVER (PARTITION BY id_int IS NULL ORDER BY _offset)
       ELSE id_int END AS BIGINT) AS id
FROM acc""",
    ids=("L4",),
)
def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    conformed = loading.conform(accepted_facts(spark, sf_dir)).select("_offset", F.col("id").cast("bigint").alias("id"))
    stored = table(spark, sf_dir, "orders").select("o_orderkey")
    return loading.assign_ids(conformed, order=["_offset"], stored_ids=stored)


@register(
    "assign_batches",
    oracle=HIRES_STEPS_SQL
    + f"""SELECT _pos, _tie, CAST(floor((ROW_NUMBER() OVER (ORDER BY _pos, _tie) - 1) / {specs.LOAD_BATCH_SIZE}) + 1 AS BIGINT)
       AS batch_no
FROM d WHERE final_step IS NULL""",
    ids=("O5", "L2"),
)
def assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _hires(spark, sf_dir).kept.select("_pos", "_tie")
    return loading.assign_batches(kept, order=["_pos", "_tie"])


_FACT_COLS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def _fact_and_refs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    fact = table(spark, sf_dir, "lineitem").select(*_FACT_COLS)
    # dimension replace: suppliers in debt and the largest parts are gone from the new versions
    suppliers = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0).select("s_suppkey")
    parts = table(spark, sf_dir, "part").where(F.col("p_size") <= 45).select("p_partkey")
    return fact, {"l_suppkey": suppliers, "l_partkey": parts}


@register(
    "orphan_facts",
    oracle="""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
       CASE WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) THEN 'l_suppkey'
            ELSE 'l_partkey' END AS orphan_column
FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
   OR l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)""",
    ids=("L7", "J4"),
)
def orphan_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, refs = _fact_and_refs(spark, sf_dir)
    return loading.orphans(fact, refs)


@register(
    "cascade_keep",
    oracle="""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
  AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 45)""",
    ids=("L7",),
)
def cascade_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, refs = _fact_and_refs(spark, sf_dir)
    return loading.cascade_keep(fact, refs)


_FULL_LOAD_SQL = f"""
WITH dep AS ({dim_steps_sql(fixtures.RAW_DEPARTMENTS, "supplier")} SELECT id_int, final_step FROM d),
job AS ({dim_steps_sql(fixtures.RAW_JOBS, "part")} SELECT id_int, final_step FROM d),
hires AS ({HIRES_STEPS_SQL} SELECT d_int, j_int, final_step FROM d),
kept AS (
  SELECT final_step IS NULL
         AND d_int IN (SELECT id_int FROM dep WHERE final_step IS NULL)
         AND j_int IN (SELECT id_int FROM job WHERE final_step IS NULL) AS loaded
  FROM hires
)
SELECT 'departments' AS "table", 'success' AS status,
       COUNT(*) FILTER (WHERE final_step IS NULL) AS rows_loaded,
       COUNT(*) FILTER (WHERE final_step IS NOT NULL) AS rows_rejected FROM dep
UNION ALL
SELECT 'jobs', 'success', COUNT(*) FILTER (WHERE final_step IS NULL), COUNT(*) FILTER (WHERE final_step IS NOT NULL) FROM job
UNION ALL
SELECT 'hired_employees', 'success', COUNT(*) FILTER (WHERE loaded), COUNT(*) FILTER (WHERE NOT loaded) FROM kept
"""


@register("full_load", oracle=_FULL_LOAD_SQL, ids=("L1", "L5", "L6", "S11"))
def full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = {
        "departments": fixtures.raw_departments(spark, sf_dir),
        "jobs": fixtures.raw_jobs(spark, sf_dir),
        "hired_employees": fixtures.raw_hires(spark, sf_dir),
    }
    target = scratch_path(spark, "full-load")
    return loading.full_load(spark, raw, target, position={"hired_employees": fixtures.HIRES_POSITION})


STORED_BATCHES = 20

_PROBE_SQL = """
SELECT id, id IN (SELECT o_orderkey FROM orders) AS stored FROM (SELECT DISTINCT l_orderkey + l_linenumber * 3 AS id FROM lineitem)"""


@register("id_store_probe", oracle=_PROBE_SQL, ids=("V9", "J5", "T3"))
def id_store_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order ids stored batch by batch, a third of them before the first; runs are merged on the way. Then the ids that the fact's
    lines name are asked for, more than go as values, so they are dealt to the runs' buckets."""
    store = IdStore(spark, scratch_path(spark, "id-store"))
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    store.begin(keys.where("id % 3 = 0"))
    for batch in range(STORED_BATCHES):
        store.compact(batch)
        store.add(keys.where((F.col("id") % 3 != 0) & (F.pmod(F.xxhash64("id"), F.lit(STORED_BATCHES)) == batch)), batch)
    named = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") + F.col("l_linenumber") * 3).cast("bigint").alias("id")).distinct()
    found = store.probe(named).withColumn("hit", F.lit(True))
    return named.join(found, "id", "left").select("id", F.coalesce("hit", F.lit(False)).alias("stored"))


LEASE_BATCHES, LEASE_BLOCK = 3, 100

_LEASED_SQL = f"""WITH RECURSIVE {_ACCEPTED_FACT_SQL.strip().removeprefix("WITH")},
facts AS (SELECT _offset, id_int, _offset % {LEASE_BATCHES} AS batch FROM acc),
per_batch AS (SELECT batch, COUNT(*) FILTER (WHERE id_int IS NULL) AS n, MAX(id_int) AS top FROM facts GROUP BY batch),
stored AS (SELECT MAX(o_orderkey) + 1 AS first_id FROM orders),
leased AS (
  SELECT CAST(-1 AS BIGINT) AS batch, CAST(0 AS BIGINT) AS block, CAST(0 AS BIGINT) AS after
  UNION ALL
  SELECT b.batch, greatest(l.after, COALESCE((b.top - s.first_id) // {LEASE_BLOCK} + 1, 0)),
         greatest(l.after, COALESCE((b.top - s.first_id) // {LEASE_BLOCK} + 1, 0)) + CAST(ceil(b.n / {LEASE_BLOCK}.0) AS BIGINT)
  FROM leased l JOIN per_batch b ON b.batch = l.batch + 1 CROSS JOIN stored s
)
SELECT f._offset, f.batch, CAST(COALESCE(f.id_int, s.first_id + l.block * {LEASE_BLOCK}
         + ROW_NUMBER() OVER (PARTITION BY f.batch, f.id_int IS NULL ORDER BY f._offset) - 1) AS BIGINT) AS id
FROM facts f JOIN leased l ON l.batch = f.batch CROSS JOIN stored s"""


@register("leased_ids", oracle=_LEASED_SQL, ids=("L4", "T3"))
def leased_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted facts come in batches; each gets ids from blocks that it leases, the orders' ids being stored before. Every batch is
    numbered a second time, as a replay does, when later batches have leased theirs; that second time is what is returned."""
    path = scratch_path(spark, "lease-input")
    loading.conform(accepted_facts(spark, sf_dir)).select("_offset", F.col("id").cast("bigint").alias("id")).write.parquet(path)
    rows = spark.read.schema("_offset bigint, id bigint").parquet(path).withColumn("batch", F.pmod("_offset", F.lit(LEASE_BATCHES)).cast("bigint"))
    leases = IdLeases(spark, scratch_path(spark, "leases"))
    leases.begin(table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("top")).first().top, LEASE_BLOCK)
    number = lambda b: assign_leased(rows.where(F.col("batch") == b), leases, b, order=["_offset"])
    for batch in range(LEASE_BATCHES):
        number(batch)
    out = number(0)
    for batch in range(1, LEASE_BATCHES):
        out = out.unionByName(number(batch))
    return out.select("_offset", "batch", "id")


@register(
    "cascade_delta",
    oracle="""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 20 = 7 AND s_acctbal < 4000)
  AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size = 50 AND p_partkey % 7 = 0)""",
    ids=("L7",),
)
def cascade_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines are stored by supplier; some suppliers go, then some parts. Only files that hold a lost key are written again."""
    path = scratch_path(spark, "cascade-fact")
    table(spark, sf_dir, "lineitem").select(*_FACT_COLS).repartitionByRange("l_suppkey", "l_orderkey").write.parquet(path)
    suppliers, parts = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), table(spark, sf_dir, "part").select("p_partkey", "p_size")
    cascade_replace(spark, path, {"l_suppkey": (suppliers, suppliers.where("not (s_suppkey % 20 = 7 and s_acctbal < 4000)"))})
    cascade_replace(spark, path, {"l_partkey": (parts, parts.where("not (p_size = 50 and p_partkey % 7 = 0)"))})
    return spark.read.parquet(path)
