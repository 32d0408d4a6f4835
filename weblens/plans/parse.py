"""Raw lines to the parsed-log table."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblens import schema as S
from weblens.functions.line_formats import (
    FORMATS,
    STRICT_ACCESS_PATTERN,
    LineFormat,
    at_line_start,
    rewrite,
)
from weblens.plans.detect import detect_format, text_bounds
from weblens.shared import broadcast_within_limit, cut_lineage

# Files whose formats are looked up one by one for a line; those of more are joined.
MOST_IN_PLAN = 100


def has_text(raw: Column) -> Column:
    """Whether a line is more than blanks; the first character mostly tells."""
    return (F.ascii(raw) > 32) | raw.rlike(r"\S")


def _by_format(choices: dict[str, Column]) -> Column:
    """One column out of several, by the row's format; NULL for formats without one."""
    chosen = F
    for name, column in choices.items():
        chosen = chosen.when(F.col("format") == name, column)
    return chosen


def _parse(lines: DataFrame, formats: Iterable[LineFormat], mixed: bool = False) -> DataFrame:
    """Parse lines that carry their `format`, one of `formats`; NULL only where `mixed`."""
    kept = [c for c in lines.columns if c not in S.LOG_FIELDS.names]
    names = tuple(f.name for f in formats)
    text, parts, columns = _parsing(lines.sparkSession.sparkContext.applicationId, names, mixed)
    # The parts come out of a generator, so they are made once per line: a filter on a
    # parsed column would otherwise be pushed down with the parsing copied into it.
    return lines.where(text).select("*", parts).select(*kept, *columns)


@lru_cache(maxsize=32)
def _parsing(
    app: str, names: tuple[str, ...], mixed: bool
) -> tuple[Column, Column, tuple[Column, ...]]:
    """What `_parse` selects, made once an application: streams parse every few seconds."""
    formats = [FORMATS[name] for name in names]
    raw, part = F.col("raw"), F.col("_part")
    by_format = _by_format if mixed else lambda choices: choices[formats[0].name]
    in_parts = by_format({f.name: f.parts(raw) for f in formats})
    read = F.size(part) == by_format({f.name: F.lit(f.size) for f in formats})
    per_format = {f.name: f.fields(raw, part) for f in formats}
    instead = {"parse_status": S.UNPARSED_STATUS, "error_level": S.UNPARSED}

    def column(field: T.StructField) -> Column:
        if field.name in ("raw", "format"):
            return F.col(field.name)
        found = {f: cols[field.name] for f, cols in per_format.items() if field.name in cols}
        if not found:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.when(read, by_format(found).cast(field.dataType))
        if field.name in instead:
            value = value.otherwise(instead[field.name])
        return value.alias(field.name)

    parts = F.explode(F.array(in_parts)).alias("_part")
    return has_text(raw), parts, tuple(column(f) for f in S.LOG_FIELDS.fields)


def parse_logs(
    lines: DataFrame,
    format: str | None = None,
    formats: DataFrame | dict[str, str] | None = None,
) -> DataFrame:
    """Parse lines into the table of `schema.LOG_FIELDS`, keeping other columns as they are.

    - `format` names the format of every line: one pass, no join, works on streams.
    - `formats` gives `(file_path, format)`, as `detect_format` returns it (with its line
      bounds, the outer blanks of each file are cut too). A dict of the formats of few files
      becomes part of the plan: nothing is written, measured or joined.
    - with neither, the formats are detected here, which reads the lines twice more.

    Blank lines are skipped; a line its format cannot read stays, as `UNPARSED`.
    """
    if format is not None:
        one = FORMATS[format]
        return _parse(lines.withColumn("format", F.lit(one.name)), [one])
    if isinstance(formats, dict):
        return _parse_few(lines, formats)
    if formats is None:
        formats = detect_format(lines)
    formats = broadcast_within_limit(cut_lineage(formats))
    known = lines.drop("format").join(formats, "file_path", "left")
    if {"first_line", "last_line"} <= set(formats.columns):
        known = trim_edges(known)
    return _parse(known, FORMATS.values(), mixed=True)


def _parse_few(lines: DataFrame, formats: dict[str, str]) -> DataFrame:
    """`parse_logs` of files whose formats the driver knows: no job but that of the lines."""
    if 0 < len(formats) <= MOST_IN_PLAN:
        # One literal, as a column for each name would take longer to make than to look up.
        of_file = F.from_json(F.lit(json.dumps(formats)), "map<string,string>")
        known = lines.withColumn("format", of_file[F.col("file_path")])
    else:
        columns = {"file_path": list(formats), "format": list(formats.values())}
        table = pa.table(columns, pa.schema([(name, pa.string()) for name in columns]))
        few = F.broadcast(lines.sparkSession.createDataFrame(table))
        known = lines.drop("format").join(few, "file_path", "left")
    used = [f for name, f in FORMATS.items() if name in set(formats.values())]
    return _parse(known, used or FORMATS.values(), mixed=True)


def trim_edges(lines: DataFrame) -> DataFrame:
    """Cut blanks before a file's first text and after its last one.

    Uses and drops `first_line` and `last_line`.
    """
    raw = F.col("raw")
    head = F.when(F.col("line_no") == F.col("first_line"), F.regexp_replace(raw, r"^\s+", ""))
    raw = F.coalesce(head, raw)
    tail = F.when(F.col("line_no") == F.col("last_line"), F.regexp_replace(raw, r"\s+$", ""))
    return lines.withColumn("raw", F.coalesce(tail, raw)).drop("first_line", "last_line")


def parse_quality(logs: DataFrame) -> DataFrame:
    """Rows per format and parse outcome."""
    return logs.groupBy("format", "parse_status").agg(F.count("*").alias("n"))


# --- strict access lines -----------------------------------------------------------


def parse_access_strict(lines: DataFrame) -> DataFrame:
    """Access lines only, numeric sizes (`-` is 0), time as text; the rest is dropped."""
    kept = [c for c in lines.columns if c != "raw"]
    groups = [f"${n}" for n in range(1, 8)]
    in_groups = rewrite(F.col("raw"), STRICT_ACCESS_PATTERN + ".*", groups)
    got = F.col("_got")
    return (
        lines.select("*", F.explode(F.array(in_groups)).alias("_got"))
        .where(F.size(got) == len(groups))
        .select(
            *kept,
            got[0].alias("ip"),
            got[1].alias("timestamp"),
            got[2].alias("method"),
            got[3].alias("path"),
            got[5].try_cast("int").alias("status_code"),
            F.when(got[6] == "-", F.lit(0))
            .otherwise(got[6].try_cast("bigint"))
            .cast("bigint")
            .alias("size"),
        )
    )


def parse_summary(lines: DataFrame, cap: int | None = None) -> DataFrame:
    """Lines of text per file, and how many of them are strict access lines.

    Lines count from a file's first text to its last, blanks between included. With
    `cap`, only that many lines from the start of the text are tried.
    """
    text = has_text(F.col("raw"))
    fits = F.col("raw").rlike(at_line_start(STRICT_ACCESS_PATTERN))
    if cap is not None:
        bounds = broadcast_within_limit(cut_lineage(text_bounds(lines)))
        lines = lines.join(bounds.select("file_path", "first_line"), "file_path", "left")
        fits = fits & (F.col("line_no") < F.col("first_line") + cap)
    spread = F.max(F.when(text, F.col("line_no"))) - F.min(F.when(text, F.col("line_no"))) + 1
    return lines.groupBy("file_path").agg(
        F.coalesce(spread, F.lit(1)).cast("bigint").alias("total_lines"),
        F.count_if(fits).alias("parsed_count"),
    )
