"""From log files to a stored table, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from weblens.plans.detect import MOST_NAMED, detect_format, detect_heads
from weblens.plans.parse import parse_logs, trim_edges
from weblens.shared import broadcast_within_limit, spread
from weblens.sources.text import (
    index_bounds,
    line_index,
    number_lines,
    scan_log_text,
)

LOG_DATE = "log_date"


def read_logs(
    spark: SparkSession,
    path: str | list[str],
    format: str | None = None,
    glob: str | None = None,
    numbered: bool = False,
) -> DataFrame:
    """Parsed lines of all log files under `path`.

    With `format` this is one pass over the text, no shuffle, no join. Without it each
    file's format is detected, and lines are numbered on the way: one light pass for the
    line index, one that picks the first lines of each file, then the parse. `numbered`
    asks for `line_no` when the format is given.
    """
    scan = scan_log_text(spark, path, glob)
    if format is not None and not numbered:
        return parse_logs(spread(scan), format)
    index = line_index(scan)
    lines = number_lines(spread(scan), index)
    if format is not None:
        return parse_logs(lines, format)
    return parse_logs(lines, formats=detect_format(lines, index_bounds(index)))


def read_detected(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    formats: DataFrame | list[Row] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Parsed lines of all log files under `path`, each in its own format, in scan order.

    The rows are those of `read_logs`, but the text is read once: formats come from the heads
    of the files, a few KB each. Only files with blanks around their text, zipped ones and
    those that workers cannot open get a light pass that finds where their text begins and
    ends. `formats` is what `detect_heads` returned, if that is known, or its rows for few files
    (see `parse_logs`). `tasks` is how many tasks read the files without that pass at most.
    """
    if formats is None:
        formats = detect_heads(spark, path, glob)
    if isinstance(formats, list):
        named = {row.file_path: row.format for row in formats}
        names = [row.file_path for row in formats if not row.smooth]
    else:
        named = formats.select("file_path", "format")
        rough = formats.where("smooth IS NOT TRUE").select("file_path").limit(MOST_NAMED + 1)
        names = [row.file_path for row in rough.collect()]

    def shared(scan: DataFrame) -> DataFrame:
        return spread(scan) if tasks is None else scan.coalesce(tasks)

    if not names:
        lines = shared(scan_log_text(spark, path, glob))
        return parse_logs(lines, formats=named)
    here = F.col("_metadata.file_path").isin(names)
    every = len(names) > MOST_NAMED  # too many to name: all files get that pass
    scan = scan_log_text(spark, path, glob, None if every else here)
    trimmed = trim_scan(spread(scan), line_index(scan))
    trimmed = parse_logs(trimmed, formats=named)
    if every:
        return trimmed
    smooth = shared(scan_log_text(spark, path, glob, ~here))
    smooth = parse_logs(smooth, formats=named)
    return smooth.unionByName(trimmed)


def trim_scan(scan: DataFrame, index: DataFrame) -> DataFrame:
    """Cut blanks around each file's text, in place; `index` is `line_index(scan)`."""
    kept = scan.columns
    places = broadcast_within_limit(index)
    line_no = F.col("lines_before") + F.col("row_id") - F.col("first_row") + 1
    lines = scan.join(places, ["file_path", "block_start"]).withColumn("line_no", line_no)
    return trim_edges(lines).select(kept)


def store_logs(
    logs: DataFrame, path: str, overwrite: bool = False, rebalance: bool = False
) -> None:
    """Write a parsed table as Parquet, one folder per day.

    Logs are mostly written in time order, so a task meets few days and no shuffle is
    needed. For jumbled input `rebalance` gathers days first; Spark then splits days that
    are too large for one task.
    """
    dated = logs.withColumn(LOG_DATE, F.to_date("ts"))
    if rebalance:
        dated = dated.hint("rebalance", LOG_DATE)
    mode = "overwrite" if overwrite else "errorifexists"
    dated.write.mode(mode).partitionBy(LOG_DATE).parquet(path)


def load_logs(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Read a stored table; days outside the bounds are not even listed as splits."""
    logs = spark.read.parquet(path)
    if start is not None:
        logs = logs.where(F.col(LOG_DATE) >= F.lit(start))
    if end is not None:
        logs = logs.where(F.col(LOG_DATE) <= F.lit(end))
    return logs.drop(LOG_DATE)
