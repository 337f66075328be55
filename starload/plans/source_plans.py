"""Source and sink queries (S1–S13): CSV landing, snapshots, queue envelopes.

Each writes its files under a fresh folder of the shared folder named by
``spark.checkpoint.dir`` and reads them back with the library's readers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload import specs
from starload.plans import fixtures
from starload.plans.registry import register
from starload.plans.tables import table
from starload.session import scratch_path
from starload.sources import backup, csv
from starload.sources.envelope import to_envelope

_LINEITEM_COLS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
_RAW_COLS = ", ".join(specs.HIRED_EMPLOYEES.columns)
_RAW_SQL = fixtures.select_sql(fixtures.RAW_HIRES, "lineitem")


def _landed_csv(spark: SparkSession, sf_dir: str) -> str:
    """The dirty fact as CSV: rows with an even position in headed files, the rest headerless."""
    raw = fixtures.raw_hires(spark, sf_dir).select("_pos", *specs.HIRED_EMPLOYEES.columns)
    root = scratch_path(spark, "csv-landing")
    csv.write_csv(raw.where(F.col("_pos") % 2 == 0).drop("_pos"), f"{root}/headed", header=True)
    csv.write_csv(raw.where(F.col("_pos") % 2 == 1).drop("_pos"), f"{root}/plain", header=False)
    return root


@register("csv_scan", oracle=f"SELECT {_RAW_COLS} FROM ({_RAW_SQL})", ids=("S1", "S2", "S5", "S6"))
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landed_csv(spark, sf_dir)
    raw = csv.read_raw(spark, root, specs.HIRED_EMPLOYEES, glob="*/*.csv")
    # the raw zone keeps the untyped rows with their source position
    landed = csv.land_raw(raw, scratch_path(spark, "raw-zone"), "hired_employees")
    return spark.read.parquet(landed).select(*specs.HIRED_EMPLOYEES.columns)


@register(
    "dataset_profile",
    oracle=f"SELECT COUNT(*) AS rows, 5 AS n_columns, '{','.join(specs.HIRED_EMPLOYEES.columns)}' AS columns FROM lineitem",
    ids=("S4", "A12"),
)
def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landed_csv(spark, sf_dir)
    df = csv.read_raw(spark, root, specs.HIRED_EMPLOYEES, glob="*/*.csv")
    return csv.profile(df)


def _as_files(lines: DataFrame, path: str, header: str | None = None) -> None:
    """Text lines as files, each with ``header`` first. The first row of a partition brings it along."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    line = F.col("line") if header is None else F.when(first, F.concat(F.lit(header + "\n"), F.col("line"))).otherwise(F.col("line"))
    lines.select(line.alias("value")).write.text(path)


_QUOTED = "'\"' || s_name || ', \"\"the ' || CASE WHEN s_suppkey % 3 = 0 THEN 'old' ELSE 'new' END || '\"\"' || CASE WHEN s_suppkey % 2 = 0 THEN ' house' ELSE '' END || '\"'"


@register(
    "structure_check",
    oracle="""SELECT folder, headed, ok, missing, extra FROM (VALUES
  ('headed', true, true, '', ''), ('plain', false, true, '', ''), ('short', true, false, 'name', 'title')) AS t(folder, headed, ok, missing, extra)
WHERE EXISTS (SELECT 1 FROM lineitem WHERE folder <> 'short') OR EXISTS (SELECT 1 FROM supplier WHERE folder = 'short')""",
    ids=("S3", "O6"),
)
def structure_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both folders of the landed fact, and one of a dimension whose header has another name; the same for any number of files."""
    root = _landed_csv(spark, sf_dir)
    suppliers = table(spark, sf_dir, "supplier").select(F.concat_ws(",", "s_suppkey", "s_name").alias("line"))
    other = scratch_path(spark, "csv-structure")
    _as_files(suppliers, f"{other}/short", 'id, "title"')
    fact = csv.structure_check(spark, root, specs.HIRED_EMPLOYEES.columns, glob="*/*.csv")
    found = fact.unionByName(csv.structure_check(spark, other, specs.DEPARTMENTS.columns, glob="short/part-*"))
    return found.select("folder", "headed", "ok", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra")).distinct()


@register(
    "csv_by_header",
    oracle="""SELECT CAST(s_suppkey AS VARCHAR) AS id,
       s_name || ', "the ' || CASE WHEN s_suppkey % 3 = 0 THEN 'old' ELSE 'new' END || '"' || CASE WHEN s_suppkey % 2 = 0 THEN chr(10) || 'house' ELSE '' END AS name
FROM supplier""",
    ids=("S1", "S2", "S6"),
)
def csv_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files of three makes: columns in either order under padded names with one more between, and without a header.
    Names hold commas, doubled quotes and line breaks."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.expr(_QUOTED).alias("name"))
    rows = rows.withColumn("name", F.regexp_replace("name", " house", "\nhouse"))
    root, number = scratch_path(spark, "csv-headers"), F.col("s_suppkey").cast("string")
    _as_files(rows.where("s_suppkey % 3 = 0").select(F.concat_ws(",", number, "name").alias("line")), f"{root}/a", "id,name")
    _as_files(rows.where("s_suppkey % 3 = 1").select(F.concat_ws(",", "name", F.lit("x"), number).alias("line")), f"{root}/b", ' name , note, "id"')
    _as_files(rows.where("s_suppkey % 3 = 2").select(F.concat_ws(",", number, "name").alias("line")), f"{root}/c")
    return csv.read_raw(spark, root, specs.DEPARTMENTS, glob="*/part-*", multiline=True).select("id", "name")


@register(
    "csv_split_records",
    oracle="""SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
       'Emp "' || CAST(l_partkey AS VARCHAR) || '",' || chr(10) || CAST(l_shipdate AS VARCHAR) || CASE WHEN l_suppkey % 3 = 0 THEN chr(10) || chr(10) || ',"' ELSE '' END AS name,
       CAST(l_quantity AS VARCHAR) AS datetime, CAST(l_suppkey AS VARCHAR) AS department_id, CAST(l_partkey AS VARCHAR) AS job_id
FROM lineitem""",
    ids=("S1", "S6"),
)
def csv_split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as files whose names hold commas, doubled quotes and line breaks, with a header of another order. A file's
    records are read by as many tasks as it has splits, and no task reads on beyond its own."""
    text = lambda c: F.col(c).cast("string")
    name = F.concat(F.lit('Emp ""'), text("l_partkey"), F.lit('"",\n'), text("l_shipdate"), F.when(F.col("l_suppkey") % 3 == 0, '\n\n,""').otherwise(""))
    cells = [text("l_suppkey"), F.concat(F.lit('"'), name, F.lit('"')), text("l_quantity"), F.concat_ws("-", "l_orderkey", "l_linenumber"), text("l_partkey")]
    root = scratch_path(spark, "csv-split")
    _as_files(table(spark, sf_dir, "lineitem").select(F.concat_ws(",", *cells).alias("line")), root, 'department_id,name,"datetime", id ,job_id')
    return csv.read_raw(spark, root, specs.HIRED_EMPLOYEES, glob="part-*", multiline=True).select(*specs.HIRED_EMPLOYEES.columns)


@register(
    "backup_restore_roundtrip",
    oracle=f"SELECT {', '.join(_LINEITEM_COLS)} FROM lineitem",
    ids=("S7", "S8", "S10", "S11"),
)
def backup_restore_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "lineitem").select(*_LINEITEM_COLS)
    backups = scratch_path(spark, "backups")
    backup.take_snapshot(src, backups, "hired_employees", as_of=dt.datetime(2024, 1, 31, 12, 0, 0))
    target = scratch_path(spark, "restored") + "/hired_employees"
    backup.restore(spark, backups, "hired_employees", target, columns=_LINEITEM_COLS)
    return spark.read.parquet(target)


_NO_IDS = "CAST(l_partkey AS STRING) || ' ' || l_returnflag AS name, l_shipdate AS datetime, l_suppkey AS department_id, l_partkey AS job_id"


@register(
    "restore_without_ids",
    oracle=f"""WITH f AS (SELECT l_linenumber, l_orderkey, {_NO_IDS} FROM lineitem), ids AS (SELECT max(l_orderkey) AS highest FROM lineitem WHERE l_linenumber = 1)
SELECT (SELECT highest FROM ids) + ROW_NUMBER() OVER (ORDER BY name, datetime, department_id, job_id) AS id, name, datetime, department_id, job_id
FROM f WHERE l_linenumber > 1
UNION ALL SELECT l_orderkey, name, datetime, department_id, job_id FROM f WHERE l_linenumber = 1""",
    ids=("S10", "S11"),
)
def restore_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of which only first lines have ids replaces a table that holds those ids."""
    facts = table(spark, sf_dir, "lineitem").selectExpr("CASE WHEN l_linenumber = 1 THEN l_orderkey END AS id", *_NO_IDS.split(", "))
    backups, target = scratch_path(spark, "backups"), scratch_path(spark, "restored") + "/hired_employees"
    facts.where("id is not null").select("id").write.parquet(target)
    backup.take_snapshot(facts, backups, "hired_employees", as_of=dt.datetime(2024, 1, 31, 12, 0, 0))
    backup.restore(spark, backups, "hired_employees", target)
    return spark.read.parquet(target)


@register(
    "profile_sample",
    oracle="""WITH f AS (SELECT s_suppkey, s_name, ROW_NUMBER() OVER (ORDER BY s_suppkey) AS place FROM supplier),
t AS (SELECT COUNT(*) AS n_rows, 'id,name' AS columns, CAST(SUM(strlen(CAST(s_suppkey AS VARCHAR) || ',' || s_name) + 1) AS BIGINT) AS size_bytes FROM f)
SELECT n_rows, columns, size_bytes, place, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name FROM f, t WHERE place <= 5""",
    ids=("S4", "A12"),
)
def profile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is told of a file set: rows, columns, size, and its first five rows (the sample is the feature)."""
    root = scratch_path(spark, "csv-profile")
    rows = table(spark, sf_dir, "supplier").repartitionByRange("s_suppkey").sortWithinPartitions("s_suppkey")
    _as_files(rows.select(F.concat_ws(",", "s_suppkey", "s_name").alias("line")), root)
    df = csv.read_raw(spark, root, specs.DEPARTMENTS, glob="part-*")
    total = csv.profile(df).select(F.col("rows").alias("n_rows"), "columns")
    size = round(csv.files_size_mb(spark, root, glob="part-*") * 1024 * 1024)
    first = csv.sample_rows(df).collect()  # five rows
    sample = spark.createDataFrame([(i, r.id, r.name) for i, r in enumerate(first, 1)], "place bigint, id string, name string")
    return sample.select(total.select("n_rows").scalar().alias("n_rows"), total.select("columns").scalar().alias("columns"), F.lit(size).cast("bigint").alias("size_bytes"), "place", "id", "name")


@register(
    "latest_backup",
    oracle="SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal >= 5000",
    ids=("S9",),
)
def latest_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier")
    backups = scratch_path(spark, "backups")
    # two snapshots of the table: all suppliers, then (a month later) those with a large balance
    backup.take_snapshot(sup.select("s_suppkey", "s_name"), backups, "departments", as_of=dt.datetime(2024, 1, 1, 0, 0, 0))
    later = sup.where(F.col("s_acctbal") >= 5000).select("s_suppkey", "s_name")
    backup.take_snapshot(later, backups, "departments", as_of=dt.datetime(2024, 2, 1, 0, 0, 0))
    return backup.latest_rows(spark, backups, "departments").drop("ts")


@register(
    "to_envelope",
    oracle="""SELECT CAST(s_suppkey AS VARCHAR) AS key,
       '{"table":"departments","payload":{"id":' || CAST(s_suppkey AS VARCHAR) || ',"name":' || to_json(s_name) || '}}' AS value,
       'raw.departments' AS topic
FROM supplier""",
    ids=("S13",),
)
def to_envelope_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return to_envelope(dims, "departments")
