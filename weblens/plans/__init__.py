from weblens.plans.detect import detect_format, detect_heads, formats_of_heads, text_bounds
from weblens.plans.ingest import load_logs, read_detected, read_logs, store_logs
from weblens.plans.parse import (
    parse_access_strict,
    parse_logs,
    parse_quality,
    parse_summary,
    trim_edges,
)
from weblens.plans.report import dashboard

__all__ = [
    "dashboard",
    "detect_format",
    "detect_heads",
    "formats_of_heads",
    "load_logs",
    "parse_access_strict",
    "parse_logs",
    "parse_quality",
    "parse_summary",
    "read_detected",
    "read_logs",
    "store_logs",
    "text_bounds",
    "trim_edges",
]
