"""Column-expression building blocks (JVM-side, codegen friendly; no Python UDFs)."""

from starload.functions.parse import lenient_timestamp, strict_timestamp, to_int_guarded, year_range
from starload.functions.text import (
    format_error,
    hash_column,
    matches_any,
    null_if_token,
    sanitize_text,
    shorten,
    strip_ws,
)

__all__ = [
    "format_error",
    "hash_column",
    "lenient_timestamp",
    "matches_any",
    "null_if_token",
    "sanitize_text",
    "shorten",
    "strict_timestamp",
    "strip_ws",
    "to_int_guarded",
    "year_range",
]
