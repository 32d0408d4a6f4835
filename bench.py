"""Time the headline queries; prints one JSON line.

`BENCH_SF_DIR` names the tables (default sf0.1), `BENCH_CPUS` the number of local cores.
Each query runs once untimed, so code generation is not measured, then twice; the faster
run counts. Results go to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from registry import lines as L  # noqa: E402
from registry.queries import QUERIES  # noqa: E402
from weblens import operators as ops  # noqa: E402
from weblens.plans import parse_logs, read_logs  # noqa: E402
from weblens.session import SETTINGS  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# From the event log (one line per event).
HEADLINE = (
    "parse_access",
    "parse_logs",
    "hourly_traffic",
    "top_paths",
    "search_logs",
    "kpi_summary",
    "errors_by_hour_level",
    "latest_errors",
    "status_sequence",
    "scan_with_line_no",
    "detect_format",
    "stream_minute_traffic",
)

# From the six times larger log derived from `lineitem`.
LARGER = {
    "items_parse": lambda logs: logs,
    "items_hourly_traffic": ops.hourly_traffic,
    "items_top_paths": ops.top_paths,
    "items_search_logs": lambda logs: ops.search_logs(logs, r"/part/49\d\d\b"),
    "items_kpi_summary": ops.kpi_summary,
}


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job) -> float:
    job()
    best = float("inf")
    for _ in range(2):
        start = time.perf_counter()
        job()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("weblens-bench")
    settings = SETTINGS | {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {name: timed(lambda n=name: run(QUERIES[n](spark, SF_DIR))) for name in HEADLINE}
    larger = parse_logs(L.order_lines(spark, SF_DIR), "apache")
    for name, query in LARGER.items():
        seconds[name] = timed(lambda q=query: run(q(larger)))
    files = L.write_log_files(spark, SF_DIR, "access.log")
    for name, kind in (("files_top_paths", "apache"), ("files_detected", None)):
        seconds[name] = timed(lambda k=kind: run(ops.top_paths(read_logs(spark, files, k))))
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
