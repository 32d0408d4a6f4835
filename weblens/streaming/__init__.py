from weblens.streaming.alerts import error_delta_by_batch, read_alerts, watch_new_errors
from weblens.streaming.detected import stream_detected, stream_formats
from weblens.streaming.parse import stream_parse
from weblens.streaming.rollups import (
    add_batch,
    rollup_counts,
    rollup_daily_ips,
    rollup_errors_by_hour_level,
    rollup_hourly_traffic,
    rollup_kpis,
    rollup_status_class_breakdown,
    rollup_unique_ips,
    stream_rollups,
)
from weblens.streaming.traffic import live_minute_traffic, stream_minute_traffic

__all__ = [
    "add_batch",
    "error_delta_by_batch",
    "live_minute_traffic",
    "read_alerts",
    "rollup_counts",
    "rollup_daily_ips",
    "rollup_errors_by_hour_level",
    "rollup_hourly_traffic",
    "rollup_kpis",
    "rollup_status_class_breakdown",
    "rollup_unique_ips",
    "stream_detected",
    "stream_formats",
    "stream_minute_traffic",
    "stream_parse",
    "stream_rollups",
    "watch_new_errors",
]
