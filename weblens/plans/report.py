"""Everything the dashboard shows, as lazy frames over one parsed table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame

from weblens import operators as ops
from weblens import schema as S


def dashboard(
    logs: DataFrame,
    start: date | None = None,
    end: date | None = None,
    levels: Iterable[str] | None = None,
    statuses: Iterable[int | None] | None = None,
    search: str = "",
    high_water=None,
    error_levels: Iterable[str] = S.ERROR_LEVELS,
    previous_errors: int | DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Apply the filters, then define each result; nothing runs until one is read.

    Give it a stored table (`load_logs`): every result then scans only its own columns.
    Without bounds the date filter spans all days, which leaves out rows without a clock
    unless no row has one. With `previous_errors`, an earlier error count as
    `ops.error_count` gives it, the rise since then is among the results.
    """
    if start is None and end is None:
        dated = ops.with_clock_if_any(logs)
    else:
        dated = ops.filter_date_range(logs, start, end)
    view = ops.filter_combined(dated, levels=levels, statuses=statuses)
    shown = ops.search_logs(view, search)
    rise = {} if previous_errors is None else {
        "error_delta": ops.error_delta(view, previous_errors, error_levels)
    }
    return rise | {
        "date_bounds": ops.date_bounds(logs),
        "method_counts": ops.method_counts(view),
        "facet_values": ops.facet_values(dated, levels=levels),
        "kpi_summary": ops.kpi_summary(view, error_levels),
        "hourly_traffic": ops.hourly_traffic(view),
        "recent_minute_traffic": ops.recent_minute_traffic(view),
        "peak_hours": ops.peak_hours(view),
        "hour_of_day_traffic": ops.hour_of_day_traffic(view),
        "level_counts": ops.level_counts(view),
        "status_share": ops.status_share(view),
        "errors_by_hour_level": ops.errors_by_hour_level(view, error_levels),
        "status_class_breakdown": ops.status_class_breakdown(view),
        "method_share": ops.method_share(view),
        "top_paths": ops.top_paths(view),
        "top_error_paths": ops.top_error_paths(view, levels=error_levels),
        "top_ips": ops.top_ips(view),
        "new_errors": ops.new_error_rows(shown, high_water, error_levels),
        "latest_errors": ops.latest_errors(shown, 10, high_water, error_levels),
        "rows": ops.flag_new_errors(shown, high_water, error_levels),
        "next_high_water": ops.next_high_water(view),
    }
