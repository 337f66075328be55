"""Parsing expressions for untrusted strings: timestamps and integer ids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# A number as the lenient cleaner accepts it: optional sign, digits with optional fraction, or a
# bare fraction, optional exponent. Guards ``try_cast(... as double)``, which also reads "12d".
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# A year leads, so that a time of day alone is no timestamp.
DATE_FIRST_PATTERN = r"^\s*[+-]?\d{4,}"
# Shapes accepted by the strict parser.
STRICT_T_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$"
STRICT_T_FRACTION_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}$"
STRICT_SPACE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_timestamp(c: ColumnOrName) -> Column:
    """Any ISO-8601 form Spark reads (``T`` or space, optional zone) → UTC wall clock, NTZ.

    Each row is parsed on its own; nothing is inferred from other rows. A date is required: a time
    of day alone would mean another instant every day, so it gives null.
    """
    col = _col(c)
    return F.when(col.rlike(DATE_FIRST_PATTERN), F.try_to_timestamp(col)).cast("timestamp_ntz")


def strict_timestamp(c: ColumnOrName) -> Column:
    """Exactly three shapes, no zone suffix; impossible dates (Feb 30) give null."""
    col = _col(c)
    t_sec = F.try_to_timestamp(col, F.lit("yyyy-M-d'T'H:m:s"))
    t_frac = F.try_to_timestamp(col, F.lit("yyyy-M-d'T'H:m:s.SSSSSS"))
    space = F.try_to_timestamp(col, F.lit("yyyy-M-d H:m:s"))
    parsed = (
        F.when(col.rlike(STRICT_T_PATTERN), t_sec)
        .when(col.rlike(STRICT_T_FRACTION_PATTERN), t_frac)
        .when(col.rlike(STRICT_SPACE_PATTERN), space)
    )
    return parsed.cast("timestamp_ntz")


def to_int_guarded(c: ColumnOrName) -> Column:
    """Numeric text → int32, fractions truncated toward zero; anything else or overflow → null."""
    col = _col(c)
    as_double = F.when(col.rlike(NUMBER_PATTERN), col.try_cast("double"))
    return F.when(F.abs(as_double) < 2147483648.0, as_double.try_cast("int"))


def ts_literal(value: dt.datetime, data_type: T.DataType) -> Column:
    """A timestamp literal of the column's own type, so the comparison reaches the Parquet scan."""
    text = value.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(data_type, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ'{text}'")
    if isinstance(data_type, T.DateType):
        return F.expr(f"DATE'{value.strftime('%Y-%m-%d')}'")
    return F.expr(f"TIMESTAMP'{text}'")


def year_range(c: str, year: int, data_type: T.DataType) -> Column:
    """``year(c) = year`` as a half-open range, which Parquet row-group statistics can prune."""
    lo = ts_literal(dt.datetime(year, 1, 1), data_type)
    hi = ts_literal(dt.datetime(year + 1, 1, 1), data_type)
    return (F.col(c) >= lo) & (F.col(c) < hi)
