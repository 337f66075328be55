"""Batch cleaning with a reason for every dropped row.

The reference cleans a file by a chain of filters that drop rows silently. Here one pass over the
rows annotates each with the *first* step it fails (``_drop_step``, null when kept), so kept rows,
dropped rows with their reason, and per-step statistics all come from the same annotated frame.

Keep-first de-duplication uses a source position (file, block, row) taken directly above the
scan. The winner per key is an aggregate (``min_by`` on the position; partial aggregation absorbs
a hot key map-side); the losers, needed only for the reject log, come from a join that AQE
splits when a key is skewed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload import specs
from starload.functions.parse import lenient_timestamp, strict_timestamp, to_int_guarded
from starload.functions.text import null_if_token, strip_ws
from starload.specs import TableSpec

# Step names in the order the checks run (fact); dims use the subset that applies.
FACT_STEPS = (
    "required",          # F1 + F3: a critical column is missing or a null token
    "name_blank",        # F4: name empty after trimming
    "name_token",        # F4: name is nan / none / null in any case (fact only)
    "timestamp",         # F5: timestamp does not parse
    "fk_token",          # F6: a foreign key is a null token after trimming
    "fk_not_numeric",    # F6: a foreign key is not a number, or does not fit int32
    "fk_not_positive",   # F6: a foreign key truncates to zero or below
    "bad_id",            # L3: the id is not an int32 integer (ours; the reference fails the batch)
    "duplicate",         # F9: a row with the same id came first
)
DIM_STEPS = ("required", "name_blank", "bad_id", "duplicate")

POSITION = "_pos"


@dataclass(frozen=True)
class CleanResult:
    annotated: DataFrame
    kept: DataFrame
    dropped: DataFrame


def steps_for(spec: TableSpec) -> tuple[str, ...]:
    return FACT_STEPS if spec.is_fact else DIM_STEPS


def null_tokens(raw: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """the eight exact null spellings become null, in every given column."""
    cols = columns or tuple(raw.columns)
    return raw.select(*[null_if_token(c).alias(c) if c in cols else F.col(c) for c in raw.columns])


def _first_failure(checks: list[tuple[str, Column]]) -> Column:
    expr = None
    for step, failed in checks:
        cond = F.coalesce(failed, F.lit(True))
        expr = F.when(cond, F.lit(step)) if expr is None else expr.when(cond, F.lit(step))
    return expr.otherwise(F.lit(None).cast("string"))


def _position_col(position: str | list[str] | tuple[str, ...]) -> Column:
    if isinstance(position, str):
        return F.col(position)
    return F.struct(*[F.col(c) for c in position])


def _position_names(position: str | list[str] | tuple[str, ...]) -> list[str]:
    return [position] if isinstance(position, str) else list(position)


def annotate(
    raw: DataFrame,
    spec: TableSpec,
    *,
    position: str | list[str] | tuple[str, ...] = POSITION,
    strict_ts: bool = False,
) -> DataFrame:
    """Typed columns plus ``_drop_step`` = first failing step before de-duplication, and
    ``_raw`` (the input row as a struct of strings, for the reject log).

    ``raw`` holds the spec's columns as STRING plus the sortable ``position`` column(s). The work
    is staged in projections so each parsed value is computed once and referenced by name.
    """
    pos = _position_names(position)
    # stage 1: exact null tokens (F1); the raw text is kept for the reject log
    t = raw.select(
        *[null_if_token(c).alias(c) for c in spec.columns],
        *pos,
        F.struct(*[F.col(c).alias(c) for c in spec.columns]).alias("_raw"),
    )
    # stage 2: trimmed and parsed values
    stage2 = [
        F.greatest(*[F.col(c).isNull() for c in spec.critical], F.lit(False)).alias("_missing"),
        strip_ws(spec.name_column).alias("_name"),
        strip_ws(spec.key).try_cast("int").alias("_id"),
    ]
    if spec.ts_column:
        ts = strict_timestamp(spec.ts_column) if strict_ts else lenient_timestamp(spec.ts_column)
        stage2.append(ts.alias("_ts"))
    for r in spec.refs:
        stage2.append(strip_ws(r.column).alias(f"_s_{r.column}"))
    t2 = t.select(*pos, "_raw", *stage2)
    # stage 3: foreign keys as int32
    stage3 = [F.col(c) for c in t2.columns]
    for r in spec.refs:
        stage3.append(to_int_guarded(F.col(f"_s_{r.column}")).alias(f"_i_{r.column}"))
    t3 = t2.select(*stage3)
    # stage 4: first failing step over plain column references
    checks: list[tuple[str, Column]] = [("required", F.col("_missing")), ("name_blank", F.col("_name") == "")]
    if spec.name_word_tokens:
        checks.append(("name_token", F.lower("_name").isin(*specs.NAME_WORD_TOKENS)))
    if spec.ts_column:
        checks.append(("timestamp", F.col("_ts").isNull()))
    if spec.refs:
        checks.append(("fk_token", F.greatest(*[F.col(f"_s_{r.column}").isin(*specs.NULL_TOKENS) for r in spec.refs])))
        checks.append(("fk_not_numeric", F.greatest(*[F.col(f"_i_{r.column}").isNull() for r in spec.refs])))
        checks.append(("fk_not_positive", F.greatest(*[F.col(f"_i_{r.column}") <= 0 for r in spec.refs])))
    checks.append(("bad_id", F.col("_id").isNull()))
    typed: dict[str, Column] = {spec.key: F.col("_id"), spec.name_column: F.col("_name")}
    if spec.ts_column:
        # stored precision is whole seconds
        typed[spec.ts_column] = F.date_trunc("second", F.col("_ts")).cast("timestamp_ntz")
    for r in spec.refs:
        typed[r.column] = F.col(f"_i_{r.column}")
    out = t3.select(
        *[typed[c].alias(c) for c in spec.columns],
        *pos,
        _first_failure(checks).alias("_drop_step"),
        "_raw",
    )
    return compute_once(out)


def compute_once(df: DataFrame) -> DataFrame:
    """Keep later filters from being pushed below the computed columns.

    Pushing a filter through a projection substitutes the projection's expressions into the
    predicate, so a filter on ``_drop_step`` would re-evaluate the whole parse chain (and blow
    the generated method past the JVM's 64 KB limit). A one-row ``inline`` generator is a point
    such predicates cannot cross; the columns above it are plain references.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def raw_json(c: str = "_raw") -> Column:
    """The input row as JSON text (built only where a row is actually logged)."""
    return F.to_json(F.col(c), {"ignoreNullFields": "false"})


def clean(
    raw: DataFrame,
    spec: TableSpec,
    *,
    position: str | list[str] | tuple[str, ...] = POSITION,
    strict_ts: bool = False,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> CleanResult:
    """Kept rows (typed, first per key), dropped rows with their first failing step.

    Kept rows come from one aggregate: per key, the row with the smallest position
    (``min_by``; partial aggregation absorbs a hot key map-side). Dropped duplicates, needed only
    for the reject log, are the eligible rows whose position is not their key's smallest.

    ``stage`` (e.g. write to the shared folder and read back) materialises the annotated rows
    once when kept and dropped rows are both consumed, so the parse chain runs once.
    """
    pos = _position_names(position)
    ann = annotate(raw, spec, position=pos, strict_ts=strict_ts)
    if stage is not None:
        ann = stage(ann)
    eligible = ann.where(F.col("_drop_step").isNull())
    keep_cols = [*spec.columns, *pos]
    winners = eligible.groupBy(spec.key).agg(
        F.min_by(F.struct(*[F.col(c) for c in keep_cols]), _position_col(pos)).alias("_w")
    )
    kept = winners.select(*[F.col(f"_w.{c}").alias(c) for c in keep_cols])
    losers = eligible.join(
        kept.select(spec.key, _position_col(pos).alias("_first")), spec.key, "left"
    ).where(_position_col(pos) != F.col("_first"))
    dropped = (
        ann.where(F.col("_drop_step").isNotNull())
        .select(*pos, "_drop_step", raw_json().alias("_raw"))
        .unionByName(losers.select(*pos, F.lit("duplicate").alias("_drop_step"), raw_json().alias("_raw")))
    )
    return CleanResult(ann, kept, dropped)


def clean_stats(annotated: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows removed by each step, rows left after it, percent of the input removed.

    One global aggregate over the annotated rows: a count per failing step, and duplicates as
    eligible rows minus distinct eligible keys.
    """
    steps = steps_for(spec)
    step = F.col("_drop_step")
    aggs = [F.count(F.lit(1)).alias("_total")]
    for s in steps:
        if s != "duplicate":
            aggs.append(F.count_if(step == s).alias(f"_n_{s}"))
    aggs.append(F.count_if(step.isNull()).alias("_eligible"))
    aggs.append(F.count_distinct(F.when(step.isNull(), F.col(spec.key))).alias("_distinct"))
    totals = annotated.agg(*aggs)
    removed = [
        (F.col("_eligible") - F.col("_distinct")) if s == "duplicate" else F.col(f"_n_{s}") for s in steps
    ]
    rows = F.explode(
        F.array(*[F.struct(F.lit(i + 1).alias("step_no"), F.lit(s).alias("step"), r.cast("bigint").alias("removed"))
                  for i, (s, r) in enumerate(zip(steps, removed, strict=True))])
    )
    out = totals.select("_total", rows.alias("_r")).select("_total", "_r.*")
    left = F.col("_total") - F.sum("removed").over(_cumulative())
    return out.select(
        "step_no",
        "step",
        "removed",
        left.cast("bigint").alias("rows_left"),
        F.when(F.col("_total") > 0, F.round(F.col("removed") * 100.0 / F.col("_total"), 2)).otherwise(F.lit(0.0)).alias("pct_removed"),
    )


def _cumulative():
    from pyspark.sql import Window

    return Window.orderBy("step_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def survivors(annotated: DataFrame, spec: TableSpec, after: str) -> DataFrame:
    """Rows still present after step ``after`` (their first failure, if any, comes later)."""
    steps = steps_for(spec)
    later = steps[steps.index(after) + 1 :]
    return annotated.where(F.col("_drop_step").isNull() | F.col("_drop_step").isin(*later))
