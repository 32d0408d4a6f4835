"""The registered queries in DuckDB SQL, over the same tables.

Written apart from the Spark code: patterns per field instead of one rewrite, window
functions instead of block offsets, and so on.
"""

from __future__ import annotations

CLOCK = "strftime(ts, '%d/%b/%Y:%H:%M:%S')"

ACCESS_LINE = f"""
CASE
  WHEN event_id % 97 = 0 THEN 'noise ' || event_id
  WHEN event_id % 89 = 0 THEN '10.0.0.' || (user_id % 256) || ' - - [' || {CLOCK}
       || ' +0000] "GET /' || event_type || '" 408 -'
  ELSE '10.0.' || (user_id // 256) || '.' || (user_id % 256) || ' - - [' || {CLOCK}
       || ' +0000] "' || CASE event_type WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT'
       ELSE 'GET' END || ' /' || event_type || '/' || (event_id % 13) || ' HTTP/1.1" '
       || CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 500
               WHEN event_type = 'error' THEN 404
               WHEN event_id % 11 = 0 THEN 302 ELSE 200 END
       || ' ' || CAST(floor(value) AS BIGINT)
END"""

ERROR_LINE = """
'[' || strftime(ts, '%a %b %d %H:%M:%S %Y') || '] ['
  || CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'warn'
          WHEN 'click' THEN 'crit' ELSE 'notice' END || '] user ' || user_id"""

GENERIC_LINE = """
strftime(ts, '%Y-%m-%d %H:%M:%S') || ' '
  || CASE event_type WHEN 'error' THEN 'FATAL' WHEN 'view' THEN 'warn' ELSE 'info' END
  || ' user=' || user_id || ' ' || props"""


def event_lines(file: str, line: str) -> str:
    return f"SELECT '{file}' AS file_path, event_id + 1 AS line_no, {line} AS raw FROM events"


ACCESS_LINES = event_lines("access.log", ACCESS_LINE)
LOG_LINES = " UNION ALL ".join(
    event_lines(file, line)
    for file, line in [
        ("access.log", ACCESS_LINE),
        ("error.log", ERROR_LINE),
        ("app.log", GENERIC_LINE),
    ]
)


def text_lines(name: str, key: str, column: str) -> str:
    return f"""
    SELECT file_path, CAST(i AS BIGINT) AS line_no, cut[i] AS raw
    FROM (SELECT file_path, cut, unnest(range(1, len(cut) + 1)) AS i
          FROM (SELECT '{name}/' || {key} AS file_path,
                       string_split({column}, chr(10)) AS cut FROM {name}))"""


PROSE_LINES = f"""
{text_lines("documents", "doc_id", "text")} UNION ALL {text_lines("pages", "page_id", "html")}"""
ALL_LINES = f"{LOG_LINES} UNION ALL {PROSE_LINES}"

# --- parsing -----------------------------------------------------------------------

# The patterns of the four line formats.
ACCESS_RE = r'^(\S+) \S+ \S+ \[(.*?)\] "(\S+) (\S+) (\S+)" (\d+) (\S+)'
NGINX_RE = r'^(\S+) - - \[(.*?)\] "(\S+) (\S+) (\S+)" (\d+) (\d+)'
ERROR_RE = r"^\[(.*?)\] \[(.*?)\] (.*)"
STRICT_RE = r'^(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+) (\S+)" (\d+) (\d+|-)'
BLANK = r"[ \t\n\x0B\f\r]"
WORD = r"[^ \t\n\x0B\f\r]"


def group(pattern: str, n: int) -> str:
    return f"regexp_extract(raw, '{pattern}', {n})"


def access_clock(text: str) -> str:
    return f"try_strptime(split_part({text}, ' ', 1), '%d/%b/%Y:%H:%M:%S')"


def whole_number(text: str, type_name: str) -> str:
    """DuckDB also casts `3.` or `2.7`, which are no status and no size."""
    return f"CASE WHEN regexp_matches({text}, '^[+-]?[0-9]+$') THEN TRY_CAST({text} AS {type_name}) END"


def level_of(status: str) -> str:
    return f"""CASE WHEN {status} < 300 THEN 'SUCCESS' WHEN {status} < 400 THEN 'REDIRECT'
      WHEN {status} < 500 THEN 'CLIENT_ERROR' ELSE 'SERVER_ERROR' END"""


NAMES = (
    "file_path, line_no, raw, format, parse_status, ip, method, path, protocol, timestamp_raw,"
    " ts, status_raw, status_code, size_raw, size_bytes, error_level, message"
)
NO_TEXT = "CAST(NULL AS VARCHAR)"


def request_rows(lines: str, pattern: str, name: str, with_text: bool) -> str:
    """Lines that match a request pattern."""
    status = f"TRY_CAST({group(pattern, 6)} AS INTEGER)"
    return f"""
    SELECT file_path, line_no, raw, '{name}' AS format, 'matched' AS parse_status,
      {group(pattern, 1)} AS ip, {group(pattern, 3)} AS method, {group(pattern, 4)} AS path,
      {group(pattern, 5)} AS protocol,
      {group(pattern, 2) if with_text else NO_TEXT} AS timestamp_raw,
      {access_clock(group(pattern, 2))} AS ts, {group(pattern, 6)} AS status_raw,
      {status} AS status_code, {group(pattern, 7)} AS size_raw,
      {whole_number(group(pattern, 7), "BIGINT")} AS size_bytes,
      {level_of(status)} AS error_level, {NO_TEXT} AS message
    FROM ({lines}) WHERE regexp_matches(raw, '{pattern}')"""


def unparsed_rows(lines: str, condition: str, name: str) -> str:
    return f"""
    SELECT file_path, line_no, raw, '{name}' AS format, 'unparsed' AS parse_status,
      {NO_TEXT} AS ip, {NO_TEXT} AS method, {NO_TEXT} AS path, {NO_TEXT} AS protocol,
      {NO_TEXT} AS timestamp_raw, CAST(NULL AS TIMESTAMP) AS ts, {NO_TEXT} AS status_raw,
      CAST(NULL AS INTEGER) AS status_code, {NO_TEXT} AS size_raw,
      CAST(NULL AS BIGINT) AS size_bytes, 'UNPARSED' AS error_level, {NO_TEXT} AS message
    FROM ({lines}) WHERE regexp_matches(raw, '{WORD}') AND {condition}"""


def malformed_rows(lines: str) -> str:
    """Lines no access line, read as far as possible."""
    words = "list_filter(regexp_split_to_array({}, '" + BLANK + "+'), lambda w: w <> '')"
    request = words.format("regexp_extract(raw, '\"([^\"]*)\"', 1)")
    tail = words.format("split_part(raw, '\"', -1)")
    return f"""
    SELECT file_path, line_no, raw, 'apache' AS format, 'fallback' AS parse_status,
      tokens[1] AS ip, coalesce(request[1], '-') AS method, coalesce(request[2], '-') AS path,
      coalesce(request[3], '-') AS protocol, bracket AS timestamp_raw,
      CASE WHEN contains(bracket, ' ') THEN {access_clock("bracket")} END AS ts,
      coalesce(tail[1], '-') AS status_raw,
      {whole_number("tail[1]", "INTEGER")} AS status_code,
      coalesce(tail[2], '-') AS size_raw,
      {whole_number("tail[2]", "BIGINT")} AS size_bytes,
      'INFO' AS error_level, {NO_TEXT} AS message
    FROM (
      SELECT *, {request} AS request,
        CASE WHEN contains(raw, '"') THEN {tail} ELSE tokens[len(tokens) - 1:] END AS tail,
        CASE WHEN regexp_matches(raw, '\\[(.*?)\\]')
             THEN regexp_extract(raw, '\\[(.*?)\\]', 1) ELSE '-' END AS bracket
      FROM (SELECT *, regexp_split_to_array(raw, '{BLANK}*"{BLANK}*|{BLANK}+') AS tokens
            FROM ({lines}) WHERE regexp_matches(raw, '{WORD}')
              AND NOT regexp_matches(raw, '{ACCESS_RE}'))
      WHERE len(tokens) >= 5)"""


TOO_FEW = f"""NOT regexp_matches(raw, '{ACCESS_RE}')
  AND len(regexp_split_to_array(raw, '{BLANK}*"{BLANK}*|{BLANK}+')) < 5"""


def access_rows(lines: str) -> str:
    return f"""
    {request_rows(lines, ACCESS_RE, "apache", True)} UNION ALL {malformed_rows(lines)}
    UNION ALL {unparsed_rows(lines, TOO_FEW, "apache")}"""


def nginx_rows(lines: str) -> str:
    return f"""
    {request_rows(lines, NGINX_RE, "nginx", False)} UNION ALL
    {unparsed_rows(lines, f"NOT regexp_matches(raw, '{NGINX_RE}')", "nginx")}"""


def error_rows(lines: str) -> str:
    level = f"upper({group(ERROR_RE, 2)})"
    return f"""
    SELECT file_path, line_no, raw, 'error' AS format, 'matched' AS parse_status,
      {NO_TEXT} AS ip, {NO_TEXT} AS method, {NO_TEXT} AS path, {NO_TEXT} AS protocol,
      {NO_TEXT} AS timestamp_raw,
      try_strptime({group(ERROR_RE, 1)}, '%a %b %d %H:%M:%S %Y') AS ts,
      {NO_TEXT} AS status_raw,
      CASE WHEN contains({level}, 'ERROR') OR contains({level}, 'CRIT') THEN 500
           WHEN contains({level}, 'WARN') THEN 400 ELSE 200 END AS status_code,
      {NO_TEXT} AS size_raw, CAST(NULL AS BIGINT) AS size_bytes,
      {level} AS error_level, {group(ERROR_RE, 3)} AS message
    FROM ({lines}) WHERE regexp_matches(raw, '{ERROR_RE}')
    UNION ALL {unparsed_rows(lines, f"NOT regexp_matches(raw, '{ERROR_RE}')", "error")}"""


ISO = r"\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}"
SLASHED = r"\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2}"


def generic_rows(lines: str) -> str:
    return f"""
    SELECT file_path, line_no, raw, 'generic' AS format, 'matched' AS parse_status,
      {NO_TEXT} AS ip, {NO_TEXT} AS method, {NO_TEXT} AS path, {NO_TEXT} AS protocol,
      {NO_TEXT} AS timestamp_raw,
      CASE WHEN regexp_matches(raw, '{ISO}')
           THEN try_strptime(regexp_extract(raw, '{ISO}'), '%Y-%m-%d %H:%M:%S')
           WHEN regexp_matches(raw, '{SLASHED}')
           THEN try_strptime(regexp_extract(raw, '{SLASHED}'), '%d/%b/%Y:%H:%M:%S')
           ELSE try_strptime(regexp_extract(raw, '\\[(.*?)\\]', 1), '%a %b %d %H:%M:%S %Y')
      END AS ts,
      {NO_TEXT} AS status_raw, CAST(NULL AS INTEGER) AS status_code, {NO_TEXT} AS size_raw,
      CAST(NULL AS BIGINT) AS size_bytes,
      CASE WHEN regexp_matches(upper(raw), 'ERROR|CRITICAL|FATAL') THEN 'ERROR'
           WHEN contains(upper(raw), 'WARN') THEN 'WARNING' ELSE 'INFO' END AS error_level,
      raw AS message
    FROM ({lines}) WHERE regexp_matches(raw, '{WORD}')"""


# --- detection and whole files -----------------------------------------------------

BOUNDS = f"""
SELECT file_path, min(line_no) AS first_line, max(line_no) AS last_line
FROM ({ALL_LINES}) WHERE regexp_matches(raw, '{WORD}') GROUP BY file_path"""

DETECTED = f"""
SELECT file_path,
  CASE WHEN 2 * apache >= n THEN 'apache' WHEN 2 * nginx >= n THEN 'nginx'
       WHEN 2 * error >= n THEN 'error' ELSE 'generic' END AS format, first_line, last_line
FROM (
  SELECT file_path, first_line, last_line, count(*) AS n,
    count(*) FILTER (WHERE regexp_matches(raw, '{ACCESS_RE}')) AS apache,
    count(*) FILTER (WHERE regexp_matches(raw, '{NGINX_RE}')) AS nginx,
    count(*) FILTER (WHERE regexp_matches(raw, '{ERROR_RE}')) AS error
  FROM (SELECT b.*, CASE WHEN line_no = first_line THEN regexp_replace(raw, '^{BLANK}+', '')
                         ELSE raw END AS raw
        FROM ({ALL_LINES}) JOIN ({BOUNDS}) b USING (file_path)
        WHERE line_no BETWEEN first_line AND least(last_line, first_line + 9))
  GROUP BY file_path, first_line, last_line)"""

TRIMMED = f"""
SELECT file_path, line_no, format,
  CASE WHEN line_no = last_line THEN regexp_replace(cut, '{BLANK}+$', '') ELSE cut END AS raw
FROM (SELECT file_path, line_no, format, last_line,
        CASE WHEN line_no = first_line THEN regexp_replace(raw, '^{BLANK}+', '') ELSE raw END AS cut
      FROM ({ALL_LINES}) JOIN ({DETECTED}) USING (file_path))"""


def of_format(name: str) -> str:
    return f"SELECT file_path, line_no, raw FROM t WHERE format = '{name}'"


PARSED = f"""
WITH t AS MATERIALIZED ({TRIMMED})
SELECT {NAMES} FROM (
  {access_rows(of_format("apache"))} UNION ALL {nginx_rows(of_format("nginx"))}
  UNION ALL {error_rows(of_format("error"))} UNION ALL {generic_rows(of_format("generic"))})"""

# --- access logs and the view ------------------------------------------------------

LOGS = f"WITH logs AS MATERIALIZED ({access_rows(ACCESS_LINES)})"
VIEW = f"{LOGS}, v AS (SELECT * FROM logs WHERE ts IS NOT NULL)"
IS_ERROR = "error_level IN ('ERROR', 'SERVER_ERROR', 'CLIENT_ERROR')"
DATED = "ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'"
IN_LEVELS = "error_level IN ('SUCCESS', 'CLIENT_ERROR', 'INFO')"
COMBINED = f"""{LOGS} SELECT {NAMES} FROM logs
WHERE {DATED} AND {IN_LEVELS} AND status_code IN (200, 404)"""
MARK = "(SELECT max(ts) FROM logs WHERE ts < TIMESTAMP '2024-01-21')"


def filtered(condition: str) -> str:
    return f"{LOGS} SELECT line_no, ts, status_code, error_level, raw FROM logs WHERE {condition}"


def counted(key: str, name: str, count: str = "requests", where: str = "TRUE") -> str:
    return f"""SELECT {key} AS {name}, count(*) AS {count} FROM v
    WHERE {key} IS NOT NULL AND {where} GROUP BY 1"""


def top(key: str, count: str, k: int, where: str = "TRUE") -> str:
    return f"{VIEW} {counted(key, key, count, where)} ORDER BY {count} DESC, {key} LIMIT {k}"


def shares(counts: str) -> str:
    return f"{VIEW} SELECT *, n * 100.0::DOUBLE / (SELECT sum(n) FROM ({counts})) AS share FROM ({counts})"


SEARCH_HIT = " OR ".join(
    rf"regexp_matches(CAST({c} AS VARCHAR), '(?i)purchase/1[0-2]|\b500\b')"
    for c in (
        "raw", "error_level", "ts", "status_code", "message", "timestamp_raw", "ip",
        "method", "path", "protocol", "status_raw", "size_raw",
    )
)


def alerts(rows: str) -> str:
    return f"""{LOGS}, flagged AS (
      SELECT *, coalesce({IS_ERROR} AND ts > {MARK}, FALSE) AS is_new FROM logs)
    SELECT line_no, ts, error_level, is_new,
      CASE WHEN is_new THEN 'new' WHEN error_level IN ('ERROR', 'SERVER_ERROR') THEN 'error'
           WHEN error_level = 'CLIENT_ERROR' THEN 'warning' ELSE 'none' END AS severity,
      CASE WHEN is_new THEN 'NEW ' ELSE '' END || error_level || ' ['
        || coalesce(strftime(ts, '%Y-%m-%d %H:%M:%S'), 'Unknown time') || ']: '
        || coalesce(message, raw, 'No message') AS alert
    FROM flagged {rows}"""


# --- written files -----------------------------------------------------------------

PER_FILE = 2500
WRITTEN = f"""
SELECT file_path || '/' || ((line_no - 1) // {PER_FILE}) AS source,
  (line_no - 1) % {PER_FILE} + 1 AS line_no, raw
FROM ({LOG_LINES})"""

# The same rules over the lines of written files.
FILE_LINES = f"SELECT source AS file_path, line_no, raw FROM ({WRITTEN})"
FILE_FORMATS = DETECTED.replace(ALL_LINES, FILE_LINES)
FILE_ROWS = f"""SELECT file_path AS source, {NAMES.replace("file_path, line_no, ", "")}
FROM ({PARSED.replace(ALL_LINES, FILE_LINES)})"""

RECENT = "ts >= (SELECT max(ts) - INTERVAL 1440 MINUTE FROM {0})"
KPI = {
    "total_requests": "count(*)",
    "error_count": f"count(*) FILTER (WHERE {IS_ERROR})",
    "error_rate": f"coalesce(count(*) FILTER (WHERE {IS_ERROR})::DOUBLE / nullif(count(*), 0) * 100, 0)",
    "time_span_days": "CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000) AS BIGINT)",
    "unique_ips": "count(DISTINCT ip)",
}
HOUR = "date_trunc('hour', ts)"
MINUTE = "date_trunc('minute', ts)"
METHODS = counted("method", "method", "n")
STATUSES = f"{counted('status_code', 'status_code', 'n')} ORDER BY n DESC, status_code LIMIT 10"

ORACLE: dict[str, str] = {
    "scan_log_text": f"""
        SELECT source, raw FROM ({WRITTEN})
        UNION ALL SELECT source, raw FROM ({WRITTEN}) WHERE source LIKE 'app.log/%'""",
    "scan_with_line_no": WRITTEN,
    "log_file_inventory": f"""
        SELECT source, 'file' AS type, CAST(sum(strlen(raw) + 1) AS BIGINT) AS size
        FROM ({WRITTEN}) GROUP BY source""",
    "list_entries": f"""
        SELECT source, 'file' AS type, CAST(sum(strlen(raw) + 1) AS BIGINT) AS size
        FROM ({WRITTEN}) GROUP BY source
        UNION ALL SELECT DISTINCT source, 'directory', 0 FROM ({WRITTEN})
        UNION ALL SELECT DISTINCT split_part(source, '/', 1), 'directory', 0 FROM ({WRITTEN})""",
    "log_profile": f"""
        SELECT source, count(*) AS total_lines,
          CAST(sum(length(raw) + 1) AS BIGINT) AS size_chars,
          string_agg(raw, chr(10) ORDER BY line_no) FILTER (WHERE line_no <= 10) AS sample
        FROM ({WRITTEN}) GROUP BY source""",
    "write_text": f"SELECT raw FROM ({ACCESS_LINES})",
    "export_csv": COMBINED,
    "table_key_lookup": """
        SELECT c_custkey, c_name FROM customer
        WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""",
    "keyed_lookup": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < -900)""",
    "table_scan_filter": """
        SELECT * FROM customer WHERE c_acctbal < 0 AND c_mktsegment = 'BUILDING'""",
    "detect_format": DETECTED,
    "detect_heads": f"""
        WITH found AS (SELECT file_path AS source, format FROM ({FILE_FORMATS}))
        FROM found UNION ALL FROM found WHERE source LIKE 'app.log/%'""",
    "read_detected": FILE_ROWS,
    "parse_access": request_rows(ACCESS_LINES, ACCESS_RE, "apache", True),
    "parse_access_fallback": f"""
        WITH t AS MATERIALIZED ({ACCESS_LINES} UNION ALL {PROSE_LINES})
        {malformed_rows("SELECT * FROM t")} UNION ALL
        {unparsed_rows("SELECT * FROM t", TOO_FEW, "apache")}""",
    "parse_nginx": nginx_rows(ACCESS_LINES),
    "parse_error": error_rows(event_lines("error.log", ERROR_LINE)),
    "parse_generic": generic_rows(ALL_LINES),
    "parse_logs": PARSED,
    "parse_access_strict": f"""
        SELECT file_path, line_no, {group(STRICT_RE, 1)} AS ip, {group(STRICT_RE, 2)} AS timestamp,
          {group(STRICT_RE, 3)} AS method, {group(STRICT_RE, 4)} AS path,
          TRY_CAST({group(STRICT_RE, 6)} AS INTEGER) AS status_code,
          CASE WHEN {group(STRICT_RE, 7)} = '-' THEN 0
               ELSE TRY_CAST({group(STRICT_RE, 7)} AS BIGINT) END AS size
        FROM ({ALL_LINES}) WHERE regexp_matches(raw, '{STRICT_RE}')""",
    "parse_summary": f"""
        SELECT file_path,
          coalesce(max(line_no) FILTER (WHERE regexp_matches(raw, '{WORD}'))
                 - min(line_no) FILTER (WHERE regexp_matches(raw, '{WORD}')) + 1, 1) AS total_lines,
          count(*) FILTER (WHERE regexp_matches(raw, '{STRICT_RE}')) AS parsed_count
        FROM ({ALL_LINES}) GROUP BY file_path""",
    "parse_quality": f"""
        SELECT format, parse_status, count(*) AS n FROM ({PARSED}) GROUP BY format, parse_status""",
    "date_bounds": f"""{VIEW}
        SELECT CAST(min(ts) AS DATE) AS min_date, CAST(max(ts) AS DATE) AS max_date FROM v""",
    "filter_date_range": filtered(DATED),
    "filter_level": filtered(IN_LEVELS),
    "filter_status": filtered("(status_code IN (404, 408) OR status_code IS NULL)"),
    "filter_pipeline": COMBINED,
    "facet_values": f"""{LOGS}
        SELECT DISTINCT 'error_level' AS facet, error_level AS value FROM logs WHERE {DATED}
        UNION ALL
        SELECT DISTINCT 'status_code', CAST(status_code AS VARCHAR) FROM logs
        WHERE {DATED} AND {IN_LEVELS}""",
    "facet_counts": f"""{LOGS}
        SELECT 'error_level' AS facet, error_level AS value, count(*) AS n FROM logs
        WHERE {DATED} AND status_code IN (200, 404) GROUP BY 2
        UNION ALL
        SELECT 'status_code', CAST(status_code AS VARCHAR), count(*) FROM logs
        WHERE {DATED} AND {IN_LEVELS} GROUP BY 2""",
    "filter_errors": filtered(IS_ERROR),
    "search_logs": filtered(SEARCH_HIT),
    "filter_recent": filtered(RECENT.format("logs")),
    "project_series": f"""
        SELECT row_number() OVER (PARTITION BY file_path ORDER BY line_no) AS entry_number, *
        FROM ({generic_rows(PROSE_LINES)})""",
    **{
        name: f"{VIEW} SELECT {KPI[name]} AS {name} FROM v"
        for name in KPI
    },
    "kpi_summary": f"""{VIEW}
        SELECT {", ".join(f"{e} AS {n}" for n, e in KPI.items())}, count(ts) > 0 AS has_timestamps
        FROM v""",
    "hourly_traffic": f"{VIEW} {counted(HOUR, 'hour')}",
    "recent_minute_traffic": f"{VIEW} {counted(MINUTE, 'minute', where=RECENT.format('v'))}",
    "hour_of_day_traffic": f"{VIEW} {counted('hour(ts)', 'hour_of_day')}",
    "method_counts": f"{VIEW} {METHODS}",
    "level_counts": f"{VIEW} {counted('error_level', 'error_level', 'n')}",
    "errors_by_hour_level": f"""{VIEW}
        SELECT {HOUR} AS hour, error_level, count(*) AS n FROM v WHERE {IS_ERROR} GROUP BY 1, 2""",
    "status_class_breakdown": f"""{VIEW}
        {counted("(status_code // 100) || 'xx'", "status_class")}""",
    "peak_hours": f"""{VIEW}
        SELECT hour, strftime(hour, '%Y-%m-%d %H:%M') AS label, requests
        FROM ({counted(HOUR, "hour")}) ORDER BY requests DESC, hour LIMIT 10""",
    "top_paths": top("path", "requests", 15),
    "top_ips": top("ip", "requests", 15),
    "top_status": top("status_code", "n", 10),
    "top_error_paths": top("path", "errors", 10, IS_ERROR),
    "latest_errors": alerts(f"WHERE {IS_ERROR} ORDER BY line_no DESC LIMIT 10"),
    "sort_logs": f"{LOGS} SELECT {NAMES} FROM logs ORDER BY size_bytes DESC NULLS LAST, line_no",
    "status_sequence": f"""
        SELECT file_path, row_number() OVER (PARTITION BY file_path ORDER BY line_no)
          AS entry_number, status_code
        FROM ({PARSED})""",
    "method_share": shares(METHODS),
    "status_share": shares(STATUSES),
    "new_errors": f"""{LOGS} SELECT line_no, ts, error_level, raw FROM logs
        WHERE {IS_ERROR} AND ts > {MARK}""",
    "new_error_rows": alerts("WHERE is_new"),
    "dashboard_new_errors": alerts(f"WHERE is_new AND ({SEARCH_HIT})"),
    "error_delta": f"""{LOGS}
        SELECT error_count, previous_count, CASE WHEN error_count > previous_count
          THEN error_count - previous_count END AS delta
        FROM (SELECT count(*) FILTER (WHERE {IS_ERROR}) AS error_count,
                count(*) FILTER (WHERE {IS_ERROR} AND ts < TIMESTAMP '2024-01-21')
                  AS previous_count
              FROM logs)""",
    "stream_parse": f"""
        SELECT {NAMES.replace("file_path, line_no, ", "")} FROM ({access_rows(ACCESS_LINES)})""",
    "stream_detected": FILE_ROWS,
    "search_stored": filtered(SEARCH_HIT),
    "rollup_hourly_traffic": f"{VIEW} {counted(HOUR, 'hour')}",
    "rollup_errors_by_hour_level": f"""{VIEW}
        SELECT {HOUR} AS hour, error_level, count(*) AS n FROM v WHERE {IS_ERROR} GROUP BY 1, 2""",
    "rollup_status_class_breakdown": f"""{LOGS}, v AS (SELECT * FROM logs)
        {counted("(status_code // 100) || 'xx'", "status_class")}""",
    "rollup_kpis": f"""{LOGS}
        SELECT {", ".join(f"{e} AS {n}" for n, e in KPI.items() if n != "unique_ips")},
          count(ts) > 0 AS has_timestamps
        FROM logs""",
    "rollup_daily_ips": f"""{VIEW}
        SELECT CAST(ts AS DATE) AS day, count(DISTINCT ip) AS unique_ips, TRUE AS near
        FROM v GROUP BY 1 HAVING count(DISTINCT ip) > 0""",
    "stream_minute_traffic": f"{VIEW} {counted(MINUTE, 'minute', where=RECENT.format('v'))}",
}
