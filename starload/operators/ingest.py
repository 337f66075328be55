"""Checking a batch of messages end to end: envelope → rules → in-batch duplicates → split.

The same function serves the batch API call (L8), the stream's micro-batches (T3) and the
registered queries; nothing here collects rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload import specs
from starload.operators.rules import flag_in_batch_duplicates, validate
from starload.sources.envelope import parse_envelope


@dataclass(frozen=True)
class Split:
    checked: DataFrame
    accepted: DataFrame
    rejected: DataFrame


def check_messages(
    messages: DataFrame,
    *,
    dims: dict[str, DataFrame],
    targets: dict[str, DataFrame],
    as_of: dt.datetime | str | Column,
    value: str = "value",
    order: str | tuple[str, ...] = "_offset",
    batch_cols: tuple[str, ...] = ("batch_id",),
) -> DataFrame:
    """Every message with ``table``, ``payload``, ``error_type`` (null = accepted), codes, message."""
    env = parse_envelope(messages, value)
    checked = validate(env, dims=dims, targets=targets, as_of=as_of)
    bad_env = ~F.col("envelope_ok")
    checked = checked.select(
        *[c for c in checked.columns if c not in ("error_type", "error_codes", "error_message")],
        F.when(bad_env, F.lit(specs.INVALID_ENVELOPE)).otherwise(F.col("error_type")).alias("error_type"),
        F.when(bad_env, F.array(F.lit("ENVELOPE"))).otherwise(F.col("error_codes")).alias("error_codes"),
        F.when(bad_env, F.lit("ENVELOPE")).otherwise(F.col("error_message")).alias("error_message"),
    )
    return flag_in_batch_duplicates(checked, batch_cols=batch_cols, order=order)


def split(checked: DataFrame) -> Split:
    """Accepted and rejected records from one annotated frame (the caller may persist it)."""
    return Split(checked, checked.where(F.col("error_type").isNull()), checked.where(F.col("error_type").isNotNull()))


def record_index(offset: Column, batch_size: int = specs.MAX_RECORDS_PER_CALL, compat: bool = False) -> Column:
    """Index of a record in its batch as text; ``compat`` logs index 0 as null like the reference."""
    idx = (offset % batch_size).cast("string")
    return F.when(F.lit(compat) & (idx == "0"), F.lit(None).cast("string")).otherwise(idx)
