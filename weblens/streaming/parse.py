"""Parse log files as they arrive."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from weblens.plans.parse import parse_logs
from weblens.sources.text import stream_log_text

REFRESH = {"processingTime": "5 seconds"}


def stream_parse(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    format: str,
    trigger: dict | None = None,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start parsing new files under `source` into a Parquet table at `target`.

    Looks for files every five seconds unless told otherwise. The format must be given, as
    a stream cannot look at whole files first. The file sink writes each file's rows once.
    """
    lines = stream_log_text(spark, source, glob, max_files_per_trigger)
    return (
        parse_logs(lines, format)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or REFRESH))
        .start()
    )
