from weblens.operators.alerts import (
    error_delta,
    flag_new_errors,
    latest_errors,
    new_error_rows,
    new_errors,
    next_high_water,
)
from weblens.operators.facet_bitmaps import (
    build_facet_index,
    facet_counts,
    read_facet_index,
    selected_count,
)
from weblens.operators.filters import (
    date_bounds,
    facet_values,
    filter_date_range,
    filter_errors,
    filter_level,
    filter_combined,
    filter_recent,
    filter_status,
    search_logs,
    with_clock_if_any,
)
from weblens.operators.metrics import (
    error_count,
    error_rate,
    errors_by_hour_level,
    hour_of_day_traffic,
    hourly_traffic,
    kpi_summary,
    level_counts,
    method_counts,
    minute_traffic,
    recent_minute_traffic,
    status_class_breakdown,
    time_span_days,
    total_requests,
    unique_ips,
)
from weblens.operators.ranking import (
    method_share,
    peak_hours,
    sort_logs,
    status_share,
    top_error_paths,
    top_ips,
    top_paths,
    top_status,
    top_values,
)
from weblens.operators.search_index import (
    build_search_index,
    candidate_files,
    search_stored,
)
from weblens.operators.sequence import number_entries, project_series, status_sequence

__all__ = [
    "build_facet_index",
    "build_search_index",
    "candidate_files",
    "date_bounds",
    "error_count",
    "error_delta",
    "error_rate",
    "errors_by_hour_level",
    "facet_counts",
    "facet_values",
    "filter_date_range",
    "filter_errors",
    "filter_level",
    "filter_combined",
    "filter_recent",
    "filter_status",
    "flag_new_errors",
    "hour_of_day_traffic",
    "hourly_traffic",
    "kpi_summary",
    "latest_errors",
    "level_counts",
    "method_counts",
    "method_share",
    "minute_traffic",
    "new_error_rows",
    "new_errors",
    "next_high_water",
    "number_entries",
    "peak_hours",
    "project_series",
    "read_facet_index",
    "recent_minute_traffic",
    "search_logs",
    "search_stored",
    "selected_count",
    "sort_logs",
    "status_class_breakdown",
    "status_sequence",
    "status_share",
    "time_span_days",
    "top_error_paths",
    "top_ips",
    "top_paths",
    "top_status",
    "top_values",
    "total_requests",
    "unique_ips",
    "with_clock_if_any",
]
