"""Table specifications and the fixed values the behaviour depends on.

Everything here is plain data: table shapes, rule parameters and the literal lists that must
equal the reference's behaviour. Operators take a ``TableSpec`` instead of branching on names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour; kept together, in their natural order).
# ---------------------------------------------------------------------------------------------

# Exact, case-sensitive spellings read as "no value" by the batch cleaner.
NULL_TOKENS = ("nan", "NaN", "NAN", "null", "NULL", "None", "NONE", "")
# Fact names equal to one of these words in any letter case are dropped by the batch cleaner.
NAME_WORD_TOKENS = ("nan", "none", "null", "")
# Name rules: length after trimming, and the allowed characters.
NAME_MIN_LENGTH = 2
NAME_MAX_LENGTH = 255
NAME_CHARSET = r"^[a-zA-ZáéíóúÁÉÍÓÚñÑ\s\-\.]+$"
# Strict timestamp shapes: T with seconds, T with fraction, space with seconds; no zone suffix.
# Largest fact id accepted by validation (int32 maximum).
FACT_ID_MAX = 2147483647
# Batch sizes: records per API call, rows per load batch, rows per backup part.
MAX_RECORDS_PER_CALL = 1000
LOAD_BATCH_SIZE = 1000
BACKUP_PART_ROWS_CLI = 100000
# Stream flush: records per flush and seconds between flushes.
FLUSH_RECORDS = 1000
FLUSH_SECONDS = 2
# Suspicious user-agent patterns (searched case-insensitively).
SUSPICIOUS_AGENT_PATTERNS = (
    "sqlmap", "nmap", "nikto", "havij", "python-requests", "curl", "wget", "bot", "crawler", "spider",
)
# Text sanitising: control characters removed, length cap, script blocks and two URL schemes.
SANITIZE_CONTROL_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
SANITIZE_MAX_CHARS = 10000
SANITIZE_SCRIPT_BLOCK = r"<script[^>]*>.*?</script>"
SANITIZE_SCHEMES = ("javascript:", "vbscript:")
# Shortened messages: first 100 characters, then "...".
SHORTEN_AT = 100
SHORTEN_SUFFIX = "..."
# Reject-log severity by error type; anything else is a warning.
ERROR_SEVERITY = {
    "VALIDATION_ERROR": "ERROR",
    "MISSING_REQUIRED_FIELDS": "WARNING",
    "BATCH_SUMMARY": "SUCCESS",
}
ERROR_SEVERITY_DEFAULT = "WARNING"
# Audit-log event types and their display colour; anything else is black.
AUDIT_EVENT_COLOURS = {
    "AUTH_SUCCESS": "green",
    "AUTH_FAILED": "red",
    "AUTH_MISSING": "orange",
    "AUTH_INVALID": "red",
    "AUTH_EXPIRED": "orange",
    "RATE_LIMIT": "red",
    "INVALID_INPUT": "orange",
    "UNAUTHORIZED_ACCESS": "red",
}
AUDIT_EVENT_COLOUR_DEFAULT = "black"
# Rate rule: calls allowed per key and lifetime of the counter in seconds.
RATE_LIMIT_CALLS = 60
RATE_LIMIT_TTL_SECONDS = 60
# Reject-log window defaults: last N hours, rows shown, last rows in a summary, audit rows.
LOG_LAST_HOURS = 24
LOG_LIMIT = 50
LOG_SUMMARY_LAST = 5
AUDIT_LIMIT = 100
# Backup snapshot folder stamp: yyyymmddThhmmss, 15 characters.
BACKUP_STAMP_PATTERN = r"^\d{8}T\d{6}$"

# Error types written to the reject log (the first four as in the reference, the rest ours).
MISSING_REQUIRED_FIELDS = "MISSING_REQUIRED_FIELDS"
VALIDATION_ERROR = "VALIDATION_ERROR"
BATCH_SUMMARY = "BATCH_SUMMARY"
UNKNOWN_TABLE = "UNKNOWN_TABLE"
INVALID_ENVELOPE = "INVALID_ENVELOPE"
DUPLICATE_IN_BATCH = "DUPLICATE_IN_BATCH"
ORPHAN = "ORPHAN"
BAD_ID = "BAD_ID"


@dataclass(frozen=True)
class DimRef:
    """A foreign-key column of a fact and the dimension table it points to."""

    column: str
    table: str
    key: str = "id"


@dataclass(frozen=True)
class TableSpec:
    """Shape and rules of one target table."""

    name: str
    columns: tuple[str, ...]
    schema: T.StructType
    key: str = "id"
    name_column: str = "name"
    # columns that must be present for the batch cleaner
    critical: tuple[str, ...] = ()
    # columns that must be truthy for validation (V1)
    required: tuple[str, ...] = ()
    # timestamp column, if any
    ts_column: str | None = None
    # foreign keys
    refs: tuple[DimRef, ...] = field(default_factory=tuple)
    # is the id optional (assigned at load when missing)?
    id_optional: bool = False
    # upper bound for a valid id (None = no bound)
    id_max: int | None = None
    # batch cleaner drops names equal to a null word in any case
    name_word_tokens: bool = False

    @property
    def is_fact(self) -> bool:
        return bool(self.refs)


DEPARTMENTS = TableSpec(
    name="departments",
    columns=("id", "name"),
    schema=T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType(), False)]),
    critical=("id", "name"),
    required=("name",),
)

JOBS = TableSpec(
    name="jobs",
    columns=("id", "name"),
    schema=T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType(), False)]),
    critical=("id", "name"),
    required=("name",),
)

HIRED_EMPLOYEES = TableSpec(
    name="hired_employees",
    columns=("id", "name", "datetime", "department_id", "job_id"),
    schema=T.StructType(
        [
            T.StructField("id", T.IntegerType(), False),
            T.StructField("name", T.StringType(), False),
            T.StructField("datetime", T.TimestampNTZType(), False),
            T.StructField("department_id", T.IntegerType(), False),
            T.StructField("job_id", T.IntegerType(), False),
        ]
    ),
    critical=("id", "name", "datetime", "department_id", "job_id"),
    required=("name", "datetime", "department_id", "job_id"),
    ts_column="datetime",
    refs=(DimRef("department_id", "departments"), DimRef("job_id", "jobs")),
    id_optional=True,
    id_max=FACT_ID_MAX,
    name_word_tokens=True,
)

TABLES: dict[str, TableSpec] = {t.name: t for t in (DEPARTMENTS, JOBS, HIRED_EMPLOYEES)}
# Load order: dimensions before the fact that points to them.
LOAD_ORDER = ("departments", "jobs", "hired_employees")

REJECT_LOG_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("timestamp", T.TimestampNTZType(), True),
        T.StructField("table_name", T.StringType(), True),
        T.StructField("record_id", T.StringType(), True),
        T.StructField("error_type", T.StringType(), True),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("raw_data", T.StringType(), True),
    ]
)

AUDIT_LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("api_key_name", T.StringType(), True),
        T.StructField("ip_address", T.StringType(), True),
        T.StructField("user_agent", T.StringType(), True),
        T.StructField("endpoint", T.StringType(), True),
        T.StructField("method", T.StringType(), True),
        T.StructField("details", T.StringType(), True),
    ]
)


def raw_schema(spec: TableSpec) -> T.StructType:
    """All-STRING schema used to read untrusted input before typing."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in spec.columns])
