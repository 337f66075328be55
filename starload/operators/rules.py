"""Validation rules over JSON payloads (VARIANT), with ordered reason codes.

One rule set per table (chosen from ``TableSpec``), evaluated as column expressions: no Python
UDF, no per-row lookups. What a record alone decides is worked out once per record and written to the
shared folder; existence checks (foreign keys, ids already stored) read it back and are left joins to
the distinct key sets, planned by Catalyst/AQE (broadcast when measured small, shuffle
otherwise, skewed keys split). Records that ask for no key are dealt by their row number, so that those
without an id do not meet in one task.

Result per record: ``error_type`` (null when accepted), ``error_codes`` (array, rule order) and
``error_message`` (codes joined by ``"; "``).

Rule order and early exits follow the reference:
1. required fields missing or falsy (null, "", blank, 0, false, [], {}) → MISSING_REQUIRED_FIELDS, stop;
2. name length, else name characters;
3. fact timestamp: not a string → TS_TYPE, wrong shape → TS_FORMAT, both stop; in the future → TS_FUTURE;
4. each foreign key: integer, positive, present in its dimension;
5. optional id: integer, in range (fact 1..2^31-1, dims > 0), not already stored.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload import specs
from starload.functions.parse import strict_timestamp
from starload.functions.text import strip_ws
from starload.session import scratch_path
from starload.specs import TableSpec

NUMERIC_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def field(payload: Column, name: str) -> Column:
    """The payload's field as VARIANT; SQL null when the key is missing."""
    return F.try_variant_get(payload, f"$.{name}", "variant")


def vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_falsy(v: Column, t: Column | None = None) -> Column:
    """Missing, JSON null, blank string, zero, false, empty array or empty object.

    ``t`` is the value's ``schema_of_variant`` when already computed.
    """
    t = vtype(v) if t is None else t
    numeric = t.isin(*NUMERIC_TYPES) | t.startswith("DECIMAL")
    return (
        v.isNull()
        | (t == "VOID")
        | ((t == "STRING") & (strip_ws(F.try_variant_get(v, "$", "string")) == ""))
        | ((t == "BOOLEAN") & ~F.try_variant_get(v, "$", "boolean"))
        | (numeric & (F.try_variant_get(v, "$", "double") == 0))
        | (t.startswith("ARRAY") & (F.array_size(F.try_variant_get(v, "$", "array<variant>")) == 0))
        | (t == "OBJECT<>")
    )


def as_text(v: Column) -> Column:
    """A value as text: strings as themselves, anything else as its JSON form."""
    return F.when(vtype(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))


def as_int(v: Column) -> Column:
    """Integer reading: integral strings (trimmed), numbers truncated, booleans 0/1; else null."""
    return F.try_variant_get(v, "$", "bigint")


def _ts_literal(as_of: dt.datetime | str | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    text = as_of if isinstance(as_of, str) else as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(text).cast("timestamp_ntz")


def _codes(*codes: Column) -> Column:
    return F.array_compact(F.array(*codes))


def extract(records: DataFrame, spec_by_table: dict[str, TableSpec] | None = None, payload: str = "payload") -> DataFrame:
    """Typed readings of every field any rule set needs, computed once per record."""
    spec_by_table = spec_by_table or specs.TABLES
    p = F.col(payload)
    fields = sorted({f for s in spec_by_table.values() for f in (*s.required, s.name_column, s.key)}
                    | {r.column for s in spec_by_table.values() for r in s.refs}
                    | {s.ts_column for s in spec_by_table.values() if s.ts_column})
    step1 = records.select("*", *[field(p, f).alias(f"_v_{f}") for f in fields])
    step2 = step1.select("*", *[vtype(F.col(f"_v_{f}")).alias(f"_t_{f}") for f in fields])
    out = [F.col(c) for c in step2.columns]
    for f in fields:
        out.append(is_falsy(F.col(f"_v_{f}"), F.col(f"_t_{f}")).alias(f"_falsy_{f}"))
    names = {s.name_column for s in spec_by_table.values()}
    for f in names:
        v, t = F.col(f"_v_{f}"), F.col(f"_t_{f}")
        text = F.when(t == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))
        out.append(strip_ws(text).alias(f"_txt_{f}"))
    ints = {r.column for s in spec_by_table.values() for r in s.refs} | {s.key for s in spec_by_table.values()}
    for f in ints:
        out.append(as_int(F.col(f"_v_{f}")).alias(f"_int_{f}"))
    for f in {s.ts_column for s in spec_by_table.values() if s.ts_column}:
        out.append(strict_timestamp(F.try_variant_get(F.col(f"_v_{f}"), "$", "string")).alias(f"_ts_{f}"))
    return step2.select(*out)


def _asked(asks: Column, key: Column) -> list[Column]:
    """Join key of a record that may ask for ``key``: whether it does, and the key or else its row number."""
    return [F.coalesce(asks, F.lit(False)), F.when(asks, key).otherwise(F.xxhash64("_row"))]


def _exists_flag(df: DataFrame, keys: DataFrame, key_col: str, table: str, flag: str, table_col: str) -> DataFrame:
    """Left join to the distinct key set of ``table``; ``flag`` is true when the key is present."""
    k = keys.select(F.col(keys.columns[0]).cast("bigint").alias("_k")).where("_k is not null").distinct().withColumn(flag, F.lit(True))
    asks, key = _asked((F.col(table_col) == F.lit(table)) & F.col(key_col).isNotNull(), F.col(key_col))
    j = df.join(k, (asks == F.col(flag)) & (key == F.col("_k")), "left").drop("_k")
    return j.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def _stored_flag(df: DataFrame, targets: dict[str, DataFrame], key_col: str, table_col: str) -> DataFrame:
    """One left join, keyed on (table, id), against those of the records' own ids that are stored.

    The stored ids are probed by a semi-join with the records' distinct ids, so a small batch never
    makes the target tables distinct or shuffles them when Spark can broadcast the batch's side.
    """
    wanted = df.select(F.col(table_col).alias("_wt"), F.col(key_col).alias("_wk")).where("_wt is not null and _wk is not null").distinct()
    parts = [
        t.select(F.lit(name).alias("_tk"), F.col(t.columns[0]).cast("bigint").alias("_k"))
        for name, t in targets.items()
    ]
    stored = parts[0]
    for p in parts[1:]:
        stored = stored.unionByName(p)
    stored = stored.join(wanted, (F.col("_tk") == F.col("_wt")) & (F.col("_k") == F.col("_wk")), "left_semi")
    stored = stored.distinct().withColumn("_hit_stored", F.lit(True))
    asks, key = _asked(F.col(table_col).isNotNull() & F.col(key_col).isNotNull(), F.col(key_col))
    cond = (asks == F.col("_hit_stored")) & (F.coalesce(F.col(table_col), F.lit("")) == F.col("_tk")) & (key == F.col("_k"))
    j = df.join(stored, cond, "left").drop("_tk", "_k")
    return j.withColumn("_hit_stored", F.coalesce(F.col("_hit_stored"), F.lit(False)))


def _alone(records: DataFrame, spec_by_table: dict[str, TableSpec], as_of: Column, table_col: str, payload: str) -> DataFrame:
    """What a record alone decides, written once and read back: the required fields that are missing, the codes of name and
    timestamp, whether the rules stop there, the keys that it names, and a row number."""
    df = extract(records, spec_by_table, payload)
    t = F.col(table_col)
    by_table: dict[str, list[Column]] = {"_missing": [], "_parts": [], "_stop": [], "_present": []}
    for s in spec_by_table.values():
        missing = _codes(*[F.when(F.col(f"_falsy_{f}"), F.lit(f"REQUIRED({f})")) for f in s.required])
        name = F.col(f"_txt_{s.name_column}")
        name_code = (
            F.when(F.length(name) < specs.NAME_MIN_LENGTH, F.lit("NAME_SHORT"))
            .when(F.length(name) > specs.NAME_MAX_LENGTH, F.lit("NAME_LONG"))
            .when(~name.rlike("(?U)" + specs.NAME_CHARSET), F.lit("NAME_CHARSET"))
        )
        parts = [name_code]
        stop = F.lit(False)
        if s.ts_column:
            ts_code = (
                F.when(F.col(f"_t_{s.ts_column}") != "STRING", F.lit("TS_TYPE"))
                .when(F.col(f"_ts_{s.ts_column}").isNull(), F.lit("TS_FORMAT"))
                .when(F.col(f"_ts_{s.ts_column}") > as_of, F.lit("TS_FUTURE"))
            )
            parts.append(ts_code)
            stop = F.coalesce(ts_code.isin("TS_TYPE", "TS_FORMAT"), F.lit(False))
        present = F.col(f"_v_{s.key}").isNotNull() & (F.col(f"_t_{s.key}") != "VOID")
        for column, value in (("_missing", missing), ("_parts", _codes(*parts)), ("_stop", stop), ("_present", present)):
            by_table[column].append(F.when(t == s.name, value))
    ints = sorted({r.column for s in spec_by_table.values() for r in s.refs} | {s.key for s in spec_by_table.values()})
    judged = df.select(
        *records.columns,
        *[F.coalesce(*values).alias(column) for column, values in by_table.items()],
        *[F.col(f"_int_{f}") for f in ints],
        F.monotonically_increasing_id().alias("_row"),
    )
    path = scratch_path(records.sparkSession, "judged")
    judged.write.parquet(path)
    return records.sparkSession.read.schema(judged.schema).parquet(path)


def validate(
    records: DataFrame,
    *,
    dims: dict[str, DataFrame],
    targets: dict[str, DataFrame],
    as_of: dt.datetime | str | Column,
    table_col: str = "table",
    payload: str = "payload",
    spec_by_table: dict[str, TableSpec] | None = None,
) -> DataFrame:
    """Adds ``error_type``, ``error_codes``, ``error_message`` to every record.

    ``dims`` maps a dimension table name to a frame whose first column holds its ids (for the
    foreign-key rule); ``targets`` maps a target table to its stored ids (for the id rule).
    """
    spec_by_table = spec_by_table or specs.TABLES
    df = _alone(records, spec_by_table, _ts_literal(as_of), table_col, payload)
    # existence flags, one left join per key set
    for s in spec_by_table.values():
        for r in s.refs:
            df = _exists_flag(df, dims[r.table], f"_int_{r.column}", s.name, f"_hit_{s.name}_{r.column}", table_col)
    if targets:
        key_cols = {s.key for s in spec_by_table.values()}
        assert len(key_cols) == 1, "one id column name across tables"
        df = _stored_flag(df, targets, f"_int_{key_cols.pop()}", table_col)
    t = F.col(table_col)

    codes_expr = None
    for s in spec_by_table.values():
        tail = []
        for r in s.refs:
            v = F.col(f"_int_{r.column}")
            tail.append(
                F.when(v.isNull(), F.lit(f"FK_INTEGER({r.column})"))
                .when(v <= 0, F.lit(f"FK_POSITIVE({r.column})"))
                .when(~F.col(f"_hit_{s.name}_{r.column}"), F.lit(f"FK_MISSING({r.column})"))
            )
        idi = F.col(f"_int_{s.key}")
        out_of_range = (idi <= 0) | (idi > s.id_max) if s.id_max is not None else (idi <= 0)
        hit = F.col("_hit_stored") if s.name in targets else F.lit(False)
        tail.append(
            F.when(F.col("_present") & idi.isNull(), F.lit("ID_INTEGER"))
            .when(F.col("_present") & out_of_range, F.lit("ID_RANGE" if s.id_max is not None else "ID_POSITIVE"))
            .when(F.col("_present") & hit, F.lit("ID_EXISTS"))
        )
        codes = F.when(F.col("_stop"), F.col("_parts")).otherwise(F.concat("_parts", _codes(*tail)))
        codes_expr = (F.when(t == s.name, codes) if codes_expr is None else codes_expr.when(t == s.name, codes))
    empty = F.array().cast("array<string>")
    df = df.withColumn("_missing", F.coalesce("_missing", empty)).withColumn("_codes", F.coalesce(codes_expr, empty))
    known = F.coalesce(t.isin(*spec_by_table), F.lit(False))
    error_type = (
        F.when(~known, F.lit(specs.UNKNOWN_TABLE))
        .when(F.size("_missing") > 0, F.lit(specs.MISSING_REQUIRED_FIELDS))
        .when(F.size("_codes") > 0, F.lit(specs.VALIDATION_ERROR))
    )
    codes_out = (
        F.when(~known, F.array(F.concat(F.lit("UNKNOWN_TABLE("), F.coalesce(t, F.lit("")), F.lit(")"))))
        .when(F.size("_missing") > 0, F.col("_missing"))
        .otherwise(F.col("_codes"))
    )
    keep = [c for c in records.columns]
    out = df.select(
        *keep,
        error_type.alias("error_type"),
        codes_out.alias("error_codes"),
        F.col(f"_int_{specs.HIRED_EMPLOYEES.key}").alias("_payload_id"),
    )
    return out.withColumn("error_message", F.when(F.size("error_codes") > 0, F.array_join("error_codes", "; ")))


def flag_in_batch_duplicates(
    validated: DataFrame,
    *,
    batch_cols: tuple[str, ...] = ("batch_id",),
    table_col: str = "table",
    order: str | tuple[str, ...] = "_offset",
) -> DataFrame:
    """Accepted records whose explicit id repeats an earlier accepted one of the same table and
    batch → DUPLICATE_IN_BATCH (the load would otherwise fail on the key).

    The first of each (batch, table, id) is a minimum over the accepted records with an id, which is
    pre-aggregated, so neither rejected records nor an id repeated very often meet in one task.
    ``order`` must be unique in a batch.
    """
    orders = [order] if isinstance(order, str) else list(order)
    elig = F.col("error_type").isNull() & F.col("_payload_id").isNotNull()
    keys = [*batch_cols, table_col]
    first = validated.where(elig).groupBy(*[F.col(k).alias(f"_first_{k}") for k in (*keys, "_payload_id")]).agg(F.min(F.struct(*orders)).alias("_first"))
    # records that can repeat nothing are dealt by their place, so that all those without an id do not meet in one task
    on = (elig == F.lit(True)) & (F.when(elig, F.col("_payload_id")).otherwise(F.xxhash64(*orders)) == F.col("_first__payload_id"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_first_{k}"))
    joined = validated.join(first, on, "left")
    dup = F.coalesce(F.struct(*orders) > F.col("_first"), F.lit(False))
    return joined.select(
        *[c for c in validated.columns if c not in ("error_type", "error_codes", "error_message")],
        F.when(dup, F.lit(specs.DUPLICATE_IN_BATCH)).otherwise(F.col("error_type")).alias("error_type"),
        F.when(dup, F.array(F.lit("DUPLICATE"))).otherwise(F.col("error_codes")).alias("error_codes"),
        F.when(dup, F.lit("DUPLICATE")).otherwise(F.col("error_message")).alias("error_message"),
    )
