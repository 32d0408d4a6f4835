"""The registered queries: each an operator over lines derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import weblens
from registry import lines as L
from weblens import operators as ops
from weblens import schema as S
from weblens import sinks, sources, streaming
from weblens.plans import (
    dashboard,
    detect_format,
    detect_heads,
    parse_access_strict,
    parse_logs,
    parse_quality,
    parse_summary,
    read_detected,
    store_logs,
)
from weblens.shared import new_shared_path
from weblens.sources.text import stream_log_text

Query = Callable[[SparkSession, str], DataFrame]

# `ts_utc` depends on how a client prints instants, so it is left to the tests.
PARSED = ["file_path", "line_no", *[n for n in S.LOG_FIELDS.names if n != "ts_utc"]]

START, END = date(2024, 1, 5), date(2024, 1, 20)
LEVELS = [S.SUCCESS, S.CLIENT_ERROR, S.INFO]
STATUSES = [200, 404]
SEARCH = r"purchase/1[0-2]|\b500\b"
RECENT_MINUTES = 1440


def access_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_logs(L.access_lines(spark, sf_dir), "apache")


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the dashboard starts from: rows with a clock."""
    return ops.with_clock_if_any(access_logs(spark, sf_dir))


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three logs of different formats and every text of the document tables."""
    logs = L.log_lines(spark, sf_dir, *L.LINE_OF)
    return logs.unionByName(L.prose_lines(spark, sf_dir))


def all_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_logs(all_lines(spark, sf_dir))


_written: dict[tuple, str] = {}


def log_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the derived logs as text files, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        _written[key] = L.write_log_files(spark, sf_dir, *L.LINE_OF)
    return _written[key]


def streamed_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the access log for streams of lines, in files that are larger if the log is."""
    lines_per_file = L.streamed_lines_per_file(L.table(spark, sf_dir, "events").count())
    if lines_per_file == L.LINES_PER_FILE:
        return f"{log_files(spark, sf_dir)}/source=access.log"
    key = (spark.sparkContext.applicationId, sf_dir, "access.log")
    if key not in _written:
        _written[key] = L.write_log_files(
            spark, sf_dir, "access.log", lines_per_file=lines_per_file
        )
    return f"{_written[key]}/source=access.log"


def of_view(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf_dir: operator(view(spark, sf_dir), *args, **kwargs)


def high_water(logs: DataFrame) -> DataFrame:
    """The mark a look at the first part of the logs would have left."""
    return ops.next_high_water(ops.filter_date_range(logs, end=END))


# --- sources and sinks -------------------------------------------------------------


def scan_log_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain files, and zipped ones of another log."""
    zipped = L.write_log_files(spark, sf_dir, "app.log", compression="gzip")
    scan = sources.scan_log_text(spark, [log_files(spark, sf_dir), zipped])
    return scan.select(L.source_name("file_path").alias("source"), "raw")


def scan_with_line_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = sources.number_lines(sources.scan_log_text(spark, log_files(spark, sf_dir)))
    return numbered.select(L.source_name("file_path").alias("source"), "line_no", "raw")


def log_file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = sources.log_file_inventory(spark, log_files(spark, sf_dir), "*.txt")
    return files.select(L.source_name("path").alias("source"), "type", "size")


def list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders and files of the written logs; a file goes by the folder it is alone in."""
    folder = log_files(spark, sf_dir)
    found = sources.list_entries(spark, folder).where("name LIKE '%=%' OR name LIKE 'part-%'")
    inside = F.regexp_replace(F.substring_index("path", f"{folder}/", -1), "/part-[^/=]*$", "")
    return found.select(F.regexp_replace(inside, "source=|part=", "").alias("source"), "type", "size")


def log_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = sources.number_lines(sources.scan_log_text(spark, log_files(spark, sf_dir)))
    return sources.log_profile(numbered).select(
        L.source_name("file_path").alias("source"), "total_lines", "size_chars", "sample"
    )


def write_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.write_text(L.access_lines(spark, sf_dir), new_shared_path(spark, "text"))


def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_combined(spark, sf_dir)
    path = sinks.export_csv(rows, new_shared_path(spark, "csv"))
    return sinks.read_exported_csv(spark, path, rows.schema)


def table_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = L.table(spark, sf_dir, "orders").where("o_totalprice > 300000").select("o_custkey")
    customers = L.table(spark, sf_dir, "customer")
    return sources.table_key_lookup(customers, "c_custkey", keys, ["c_custkey", "c_name"])


def table_scan_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = L.table(spark, sf_dir, "customer")
    return sources.table_scan_filter(customers, "c_acctbal < 0 AND c_mktsegment = 'BUILDING'")


def keyed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of some customers, out of a table bucketed by customer."""
    orders = L.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    wanted = L.table(spark, sf_dir, "customer").where("c_acctbal < -900").select("c_custkey")
    path = new_shared_path(spark, "keyed")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    sources.write_keyed_table(orders, name, path, "o_custkey", buckets=16)
    found = sources.keyed_lookup(spark.table(name), "o_custkey", wanted)
    spark.sql(f"DROP TABLE {name}")  # the name only, its files stay
    return found


# --- parsing -----------------------------------------------------------------------


def formats_by_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats of the written files, plain and zipped, from their first lines."""
    zipped = L.write_log_files(spark, sf_dir, "app.log", compression="gzip")
    found = detect_heads(spark, [log_files(spark, sf_dir), zipped])
    return found.select(L.source_name("file_path").alias("source"), "format")


FILE_LINES = [n for n in PARSED if n not in ("file_path", "line_no")]


def lines_by_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = read_detected(spark, log_files(spark, sf_dir))
    return logs.select(L.source_name("file_path").alias("source"), *FILE_LINES)


def parse_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = access_logs(spark, sf_dir)
    return logs.where(F.col("parse_status") == S.MATCHED).select(PARSED)


def parse_access_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    malformed = L.access_lines(spark, sf_dir).unionByName(L.prose_lines(spark, sf_dir))
    logs = parse_logs(malformed, "apache")
    return logs.where(F.col("parse_status") != S.MATCHED).select(PARSED)


def parse_nginx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_logs(L.access_lines(spark, sf_dir), "nginx").select(PARSED)


def parse_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_logs(L.log_lines(spark, sf_dir, "error.log"), "error").select(PARSED)


def parse_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    free = L.log_lines(spark, sf_dir, *L.LINE_OF).unionByName(L.prose_lines(spark, sf_dir))
    return parse_logs(free, "generic").select(PARSED)


def parse_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_access_strict(all_lines(spark, sf_dir))


def filter_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = access_logs(spark, sf_dir)
    return ops.filter_combined(logs, START, END, LEVELS, STATUSES).select(PARSED)


def filtered(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """A filter over parsed lines, shown with a few columns."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = operator(access_logs(spark, sf_dir), *args, **kwargs)
        return rows.select("line_no", "ts", "status_code", "error_level", "raw")

    return query


def search_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search over logs stored by day, through the index of their trigrams."""
    place = new_shared_path(spark, "stored")
    store_logs(access_logs(spark, sf_dir), f"{place}/logs", rebalance=True)
    ops.build_search_index(spark, f"{place}/logs", f"{place}/index")
    found = ops.search_stored(spark, f"{place}/logs", f"{place}/index", SEARCH)
    return found.select("line_no", "ts", "status_code", "error_level", "raw")


def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of levels and statuses under the filters, out of bitmaps."""
    path = new_shared_path(spark, "facets")
    ops.build_facet_index(access_logs(spark, sf_dir), path)
    index = ops.read_facet_index(spark, path, START, END)
    return ops.facet_counts(index, LEVELS, STATUSES)


# --- sequences and alerts ----------------------------------------------------------


def project_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = parse_logs(L.prose_lines(spark, sf_dir), "generic")
    return ops.project_series(logs).select("entry_number", *PARSED)


ALERT = ["line_no", "ts", "error_level", "is_new", "severity", "alert"]


def new_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = access_logs(spark, sf_dir)
    rows = ops.new_errors(logs, high_water(logs))
    return rows.select("line_no", "ts", "error_level", "raw")


def new_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = access_logs(spark, sf_dir)
    return ops.new_error_rows(logs, high_water(logs)).select(ALERT)


def latest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = access_logs(spark, sf_dir)
    return ops.latest_errors(logs, 10, high_water(logs)).select(ALERT)


def dashboard_new_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new errors that the dashboard lists under a search."""
    logs = access_logs(spark, sf_dir)
    shown = dashboard(logs, search=SEARCH, high_water=high_water(logs))
    return shown["new_errors"].select(ALERT)


def error_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = access_logs(spark, sf_dir)
    before = ops.error_count(ops.filter_date_range(logs, end=END))
    return ops.error_delta(logs, before)


# --- streams -----------------------------------------------------------------------

ALL_AVAILABLE = {"availableNow": True}


def stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = f"{log_files(spark, sf_dir)}/source=access.log"
    target = new_shared_path(spark, "stream")
    streaming.stream_parse(
        spark, source, f"{target}/logs", f"{target}/checkpoint", "apache", ALL_AVAILABLE
    ).awaitTermination()
    names = [n for n in PARSED if n not in ("file_path", "line_no")]
    return spark.read.parquet(f"{target}/logs").select(names)


def stream_detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of three formats, some files a batch."""
    target = new_shared_path(spark, "stream")
    streaming.stream_detected(
        spark, log_files(spark, sf_dir), f"{target}/logs", f"{target}/formats",
        f"{target}/checkpoint", ALL_AVAILABLE, max_files_per_trigger=25,
    ).awaitTermination()
    logs = spark.read.parquet(f"{target}/logs")
    return logs.select(L.source_name("file_path").alias("source"), *FILE_LINES)


def stream_minute_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = streamed_files(spark, sf_dir)
    target = new_shared_path(spark, "stream")
    logs = parse_logs(stream_log_text(spark, source, max_files_per_trigger=4), "apache")
    streaming.stream_minute_traffic(
        logs, f"{target}/views", f"{target}/checkpoint", RECENT_MINUTES, ALL_AVAILABLE
    ).awaitTermination()
    return streaming.live_minute_traffic(spark, f"{target}/views")


_rolled: dict[tuple, str] = {}


def rolled_up(spark: SparkSession, sf_dir: str) -> str:
    """Rollups of the access log's files, streamed once per session, some files a batch."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _rolled:
        source = streamed_files(spark, sf_dir)
        target = new_shared_path(spark, "rollups")
        logs = parse_logs(stream_log_text(spark, source, max_files_per_trigger=4), "apache")
        streaming.stream_rollups(
            logs, f"{target}/kept", f"{target}/checkpoint", ALL_AVAILABLE
        ).awaitTermination()
        _rolled[key] = f"{target}/kept"
    return _rolled[key]


def of_rollup(result: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: result(streaming.rollup_counts(spark, rolled_up(spark, sf_dir)))


def rollup_daily_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact clients a day beside the sketches' estimate: whether it is within 4 percent."""
    kept = streaming.rollup_daily_ips(spark, rolled_up(spark, sf_dir))
    exact = view(spark, sf_dir).groupBy(F.to_date("ts").alias("day"))
    exact = exact.agg(F.count_distinct("ip").alias("exact"))
    near = F.abs(F.col("unique_ips") - F.col("exact")) <= F.greatest(0.04 * F.col("exact"), F.lit(1))
    both = exact.where("exact > 0").join(kept, "day", "full_outer")
    return both.select("day", F.col("exact").alias("unique_ips"), near.alias("near"))


QUERIES: dict[str, Query] = {
    # sources and sinks
    "scan_log_text": scan_log_text,
    "scan_with_line_no": scan_with_line_no,
    "log_file_inventory": log_file_inventory,
    "list_entries": list_entries,
    "log_profile": log_profile,
    "write_text": write_text,
    "export_csv": export_csv,
    "table_key_lookup": table_key_lookup,
    "keyed_lookup": keyed_lookup,
    "table_scan_filter": table_scan_filter,
    # parsing
    "detect_format": lambda s, d: detect_format(all_lines(s, d)),
    "detect_heads": formats_by_heads,
    "read_detected": lines_by_heads,
    "parse_access": parse_access,
    "parse_access_fallback": parse_access_fallback,
    "parse_nginx": parse_nginx,
    "parse_error": parse_error,
    "parse_generic": parse_generic,
    "parse_logs": lambda s, d: all_logs(s, d).select(PARSED),
    "parse_access_strict": parse_strict,
    "parse_summary": lambda s, d: parse_summary(all_lines(s, d)),
    "parse_quality": lambda s, d: parse_quality(all_logs(s, d)),
    # filters
    "date_bounds": of_view(ops.date_bounds),
    "filter_date_range": filtered(ops.filter_date_range, START, END),
    "filter_level": filtered(ops.filter_level, LEVELS),
    "filter_status": filtered(ops.filter_status, [404, 408, None]),
    "filter_pipeline": filter_combined,
    "facet_values": lambda s, d: ops.facet_values(access_logs(s, d), START, END, LEVELS),
    "facet_counts": facet_counts,
    "filter_errors": filtered(ops.filter_errors),
    "search_logs": filtered(ops.search_logs, SEARCH),
    "search_stored": search_stored,
    "filter_recent": filtered(ops.filter_recent, RECENT_MINUTES),
    "project_series": project_series,
    # aggregates
    "total_requests": of_view(ops.total_requests),
    "error_count": of_view(ops.error_count),
    "error_rate": of_view(ops.error_rate),
    "time_span_days": of_view(ops.time_span_days),
    "unique_ips": of_view(ops.unique_ips),
    "kpi_summary": of_view(ops.kpi_summary),
    "hourly_traffic": of_view(ops.hourly_traffic),
    "recent_minute_traffic": of_view(ops.recent_minute_traffic, RECENT_MINUTES),
    "hour_of_day_traffic": of_view(ops.hour_of_day_traffic),
    "method_counts": of_view(ops.method_counts),
    "level_counts": of_view(ops.level_counts),
    "errors_by_hour_level": of_view(ops.errors_by_hour_level),
    "status_class_breakdown": of_view(ops.status_class_breakdown),
    # ranking
    "peak_hours": of_view(ops.peak_hours),
    "top_paths": of_view(ops.top_paths, 15),
    "top_ips": of_view(ops.top_ips, 15),
    "top_status": of_view(ops.top_status),
    "top_error_paths": of_view(ops.top_error_paths),
    "latest_errors": latest_errors,
    "sort_logs": lambda s, d: ops.sort_logs(access_logs(s, d), "size_bytes", False).select(PARSED),
    # windows and shares
    "status_sequence": lambda s, d: ops.status_sequence(all_logs(s, d)),
    "method_share": of_view(ops.method_share),
    "status_share": of_view(ops.status_share),
    # alerts and streams
    "new_errors": new_errors,
    "new_error_rows": new_error_rows,
    "dashboard_new_errors": dashboard_new_errors,
    "error_delta": error_delta,
    "stream_parse": stream_parse,
    "stream_detected": stream_detected,
    "stream_minute_traffic": stream_minute_traffic,
    "rollup_hourly_traffic": of_rollup(streaming.rollup_hourly_traffic),
    "rollup_errors_by_hour_level": of_rollup(streaming.rollup_errors_by_hour_level),
    "rollup_status_class_breakdown": of_rollup(streaming.rollup_status_class_breakdown),
    "rollup_kpis": of_rollup(streaming.rollup_kpis),
    "rollup_daily_ips": rollup_daily_ips,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests per hour of the derived access log."""
    return weblens.hourly_traffic(access_logs(spark, sf_dir))
