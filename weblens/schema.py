"""The parsed-log table: one fixed, nullable schema for every line format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Level names a line can carry, as the dashboards expect them.
SUCCESS = "SUCCESS"
REDIRECT = "REDIRECT"
CLIENT_ERROR = "CLIENT_ERROR"
SERVER_ERROR = "SERVER_ERROR"
INFO = "INFO"
WARNING = "WARNING"
ERROR = "ERROR"
UNPARSED = "UNPARSED"
ERROR_LEVELS = (ERROR, SERVER_ERROR, CLIENT_ERROR)

# Outcome of reading one line.
MATCHED = "matched"
FALLBACK = "fallback"
UNPARSED_STATUS = "unparsed"

LOG_FIELDS = T.StructType(
    [
        T.StructField("raw", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("parse_status", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("timestamp_raw", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("ts_utc", T.TimestampType()),
        T.StructField("status_raw", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("size_raw", T.StringType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("error_level", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

# Columns that place a line in its file, best one first. `line_no` is exact;
# (`block_start`, `row_id`) sorts the same way and costs nothing to produce.
EXACT_ORDER = ("file_path", "line_no")
SCAN_ORDER = ("file_path", "block_start", "row_id")


def file_order(logs: DataFrame) -> list[str]:
    """Names of the columns that put `logs` into file order."""
    for order in (EXACT_ORDER, SCAN_ORDER):
        if set(order) <= set(logs.columns):
            return list(order)
    raise ValueError(
        f"no file order: need columns {EXACT_ORDER} or {SCAN_ORDER}, got {logs.columns}"
    )
