"""CSV landing (S1–S6): all-STRING reads with a stable source position, header sniffing by
whole tokens, structure checks, profiles, and the raw zone."""

from __future__ import annotations

import re
from csv import reader

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.sources.csv_records import Records
from starload.specs import TableSpec, raw_schema

POSITION = ("_src_file", "_block", "_row")
# Never matches a real cell: blank cells stay blank strings (no automatic null).
_NO_NULL = "\u0000"

_CSV_OPTIONS = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": _NO_NULL,
    "emptyValue": "",
    "mode": "PERMISSIVE",
    "quote": '"',
    "escape": '"',
}


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Write string columns as CSV keeping blanks and padding exactly."""
    (
        df.write.mode("overwrite")
        .option("header", str(header).lower())
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("quoteAll", "true")
        .csv(path)
    )


def first_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, line): the first line of each file, found by the tasks that read the files' first splits."""
    rows = spark.read.text(files).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        F.col("value"),
    )
    return rows.where(F.col("_block") == 0).groupBy("file").agg(F.min_by("value", "_row").alias("line"))


def _cells(line: str) -> tuple[str, ...]:
    return tuple(c.strip() for c in next(reader([line], skipinitialspace=True), []))


def header_names(line: str, expected: tuple[str, ...]) -> tuple[str, ...] | None:
    """The column names of a header line, or null for a data row.

    Cells are unquoted and trimmed. A header has distinct names only (so no number, blank or text
    with marks), among them at least half of the expected columns: a data row with one cell that
    happens to be a column name, such as ``1,id``, is none.
    """
    cells = _cells(line)
    named = all(re.fullmatch(r"[A-Za-z_][A-Za-z0-9_ ]*", c) for c in cells) and len(set(cells)) == len(cells)
    return cells if cells and named and 2 * len(set(cells) & set(expected)) >= len(expected) else None


def list_files(spark: SparkSession, path: str, glob: str = "*.csv") -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.isFile(p):
        return [str(p)]
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{glob}")
    return sorted(str(s.getPath()) for s in (fs.globStatus(pattern) or []))


def read_raw(
    spark: SparkSession, path: str, spec: TableSpec, *, header: bool | None = None, glob: str = "*.csv", multiline: bool = False
) -> DataFrame:
    """Every matching file as STRING columns in the spec's order plus a source position.

    ``header=None`` looks at each file's first line (``header=True`` says that all have one). Headed
    files are read by column *name*: those with the same header are read together with it as their
    schema, so another column order, padded names or extra columns are fine, and a missing column is
    null. Headerless files are read by position. Quotes are doubled inside quoted cells; with
    ``multiline`` these may hold line breaks, and files are still read in splits (``csv_records``).
    """
    files = list_files(spark, path, glob)
    if not files:
        return spark.createDataFrame([], _with_position(raw_schema(spec)))
    if multiline:
        return _read_records(spark, files, spec, header)
    groups: dict[tuple[str, ...] | None, list[str]] = {}
    if header is False:
        groups[None] = files
    else:
        seen = {r.file: r.line for r in first_lines(spark, files).collect()}  # one row per file, as the listing
        for file, line in sorted(seen.items()):
            names = _cells(line) if header else header_names(line, spec.columns)
            groups.setdefault(names, []).append(file)
    parts = []
    for names, group in groups.items():
        source = spark.read.options(**_CSV_OPTIONS).option("header", str(names is not None).lower())
        columns = (*spec.columns, "_extra") if names is None else names
        df = source.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(group)
        missing = {c: F.lit(None).cast("string") for c in spec.columns if c not in columns}
        parts.append(_positioned(df.withColumns(missing) if missing else df, spec))
    if not parts:  # files without a line
        return spark.createDataFrame([], _with_position(raw_schema(spec)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _read_records(spark: SparkSession, files: list[str], spec: TableSpec, header: bool | None) -> DataFrame:
    """Records of all files in one pass, whatever their headers: each file's header says which cell goes to which column."""
    records = Records(spark, files)
    rows, width = [], len(spec.columns)
    for file, (row, line) in sorted(records.openings().items()):
        names = None if header is False else _cells(line) if header else header_names(line, spec.columns)
        cells = [names.index(c) if c in names else None for c in spec.columns] if names else list(range(len(spec.columns)))
        width = max(width, len(names or ()))
        rows.append((file, row if names else None, cells))
    headers = spark.createDataFrame(rows, "file string, header_row long, cells array<int>")  # one row per file, as the listing
    parsed = F.from_csv("record", ", ".join(f"c{i} string" for i in range(width + 1)), _CSV_OPTIONS | {"multiLine": "true"})
    found = records.frame().join(F.broadcast(headers), "file").where(~F.col("row").eqNullSafe(F.col("header_row")) | (F.col("block") > 0))
    cell = F.array(*[F.col(f"parsed.c{i}") for i in range(width + 1)])
    found = found.withColumn("parsed", parsed).withColumn("cell", cell)
    columns = [F.get("cell", F.get("cells", F.lit(i))).alias(c) for i, c in enumerate(spec.columns)]
    return found.select(*columns, F.col("file").alias("_src_file"), F.col("block").alias("_block"), F.col("row").alias("_row"))


def _positioned(df: DataFrame, spec: TableSpec) -> DataFrame:
    # taken directly above the scan, before any shuffle: (file, split start, row within split)
    return df.select(
        *[F.col(c).cast("string").alias(c) for c in spec.columns],
        F.col("_metadata.file_path").alias("_src_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def _with_position(schema: T.StructType) -> T.StructType:
    return T.StructType(
        schema.fields
        + [
            T.StructField("_src_file", T.StringType(), True),
            T.StructField("_block", T.LongType(), True),
            T.StructField("_row", T.LongType(), True),
        ]
    )


def structure_check(spark: SparkSession, path: str, expected: tuple[str, ...], glob: str = "*.csv") -> DataFrame:
    """S3: per file, whether it has a header, and which expected columns that lacks (then it fails) or has besides.

    A headerless file is read by position and passes.
    """
    names = F.array(*[F.lit(c) for c in expected])
    files = list_files(spark, path, glob)
    cells = F.transform(F.split("line", ","), lambda c: F.trim(F.regexp_replace(F.trim(c), '^"|"$', "")))
    rows = first_lines(spark, files).select("file", cells.alias("cells"))
    named = F.forall("cells", lambda c: c.rlike("^[A-Za-z_][A-Za-z0-9_ ]*$")) & (F.size(F.array_distinct("cells")) == F.size("cells"))
    headed = named & (2 * F.size(F.array_intersect("cells", names)) >= len(expected))
    found = rows.select("file", headed.alias("headed"), F.when(headed, F.col("cells")).otherwise(names).alias("cells"))
    missing, extra = F.sort_array(F.array_except(names, "cells")), F.sort_array(F.array_except("cells", names))
    return found.select(
        F.element_at(F.split("file", "/"), -1).alias("file"),
        F.element_at(F.split("file", "/"), -2).alias("folder"),
        "headed",
        (F.size(missing) == 0).alias("ok"),
        missing.alias("missing"),
        extra.alias("extra"),
    )


def profile(df: DataFrame) -> DataFrame:
    """Exact row count and the columns that were read (source positions aside), in one pass."""
    columns = [c for c in df.columns if c not in POSITION]
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(columns)).alias("n_columns"),
        F.lit(",".join(columns)).alias("columns"),
    )


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows of the source in file order (a sample is the feature here). Every task
    keeps its first ``n``, then those are merged; nothing is sorted whole."""
    order = [c for c in POSITION if c in df.columns]
    return (df.orderBy(*order) if order else df).limit(n)


def files_size_mb(spark: SparkSession, path: str, glob: str = "*.csv") -> float:
    """Total size of the matching files in MB (listing metadata), not rounded."""
    jvm = spark.sparkContext._jvm
    total = 0
    for f in list_files(spark, path, glob):
        p = jvm.org.apache.hadoop.fs.Path(f)
        total += p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).getLen()
    return total / (1024 * 1024)


def land_raw(df: DataFrame, raw_zone: str, table: str) -> str:
    """Keep the untyped rows (with source position) in the raw zone as Parquet."""
    path = f"{raw_zone.rstrip('/')}/{table}"
    df.write.mode("overwrite").parquet(path)
    return path
