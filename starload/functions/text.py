"""Text expressions: trimming, null tokens, sanitising, shortening, hashing, pattern flags."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from starload import specs

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Characters Python's ``str.strip()`` removes: every code point whose ``isspace()`` is true.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def strip_ws(c: ColumnOrName) -> Column:
    """Trim whitespace at both ends as Python's ``str.strip()`` does (``trim`` removes only
    spaces). A character-set trim, no regular expression."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def null_if_token(c: ColumnOrName, tokens: tuple[str, ...] = specs.NULL_TOKENS) -> Column:
    """Exact, case-sensitive token match → null."""
    col = _col(c)
    return F.when(col.isin(*tokens), F.lit(None).cast("string")).otherwise(col)


def sanitize_text(c: ColumnOrName, max_chars: int = specs.SANITIZE_MAX_CHARS) -> Column:
    """Strip control characters, cap the length, drop script blocks and script URL schemes, trim.

    The steps run in that order, so a script block cut by the cap is not removed.
    """
    col = F.regexp_replace(_col(c), specs.SANITIZE_CONTROL_CHARS, "")
    col = F.substring(col, 1, max_chars)
    col = F.regexp_replace(col, "(?is)" + specs.SANITIZE_SCRIPT_BLOCK, "")
    for scheme in specs.SANITIZE_SCHEMES:
        col = F.regexp_replace(col, "(?i)" + re.escape(scheme), "")
    return strip_ws(col)


def shorten(c: ColumnOrName, n: int = specs.SHORTEN_AT, suffix: str = specs.SHORTEN_SUFFIX) -> Column:
    col = _col(c)
    return F.when(F.length(col) > n, F.concat(F.substring(col, 1, n), F.lit(suffix))).otherwise(col)


def hash_column(c: ColumnOrName) -> Column:
    """SHA-256 hex digest, for pseudonymising a column."""
    return F.sha2(_col(c).cast("string"), 256)


def matches_any(c: ColumnOrName, patterns: tuple[str, ...] = specs.SUSPICIOUS_AGENT_PATTERNS) -> Column:
    """True when any pattern is found in the lower-cased text; null text gives false."""
    joined = "|".join(f"(?:{p})" for p in patterns)
    return F.coalesce(F.lower(_col(c)).rlike(joined), F.lit(False))


def format_error(error_type: ColumnOrName, message: ColumnOrName, context: ColumnOrName | None = None) -> Column:
    """``[context] Type: message``, the context part only when present."""
    body = F.concat(_col(error_type), F.lit(": "), _col(message))
    if context is None:
        return body
    ctx = _col(context)
    return F.when(ctx.isNull() | (ctx == ""), body).otherwise(F.concat(F.lit("["), ctx, F.lit("] "), body))


def lookup(c: ColumnOrName, mapping: dict[str, str], default: str) -> Column:
    """Literal map lookup with a default (a CASE expression, folded into codegen)."""
    col = _col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def severity(c: ColumnOrName) -> Column:
    return lookup(c, specs.ERROR_SEVERITY, specs.ERROR_SEVERITY_DEFAULT)


def event_colour(c: ColumnOrName) -> Column:
    return lookup(c, specs.AUDIT_EVENT_COLOURS, specs.AUDIT_EVENT_COLOUR_DEFAULT)


def json_record(*cols: str, ts_format: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") -> Column:
    """A row as JSON for logging: timestamps as ISO text, NaN and infinities as null, other
    values as themselves; null fields are written (``ignoreNullFields`` off)."""
    fields = [F.col(c).alias(c) for c in cols]
    options = {"ignoreNullFields": "false", "timestampFormat": ts_format, "timestampNTZFormat": ts_format}
    return F.to_json(F.struct(*fields), options)


def nan_to_null(df_col: Column) -> Column:
    """NaN / ±infinity → null for a floating column (JSON has no such numbers)."""
    return F.when(F.isnan(df_col) | (F.abs(df_col) == float("inf")), F.lit(None)).otherwise(df_col)
