"""Which format each file is in, told from its first lines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from weblens.functions.line_formats import FORMATS, GENERIC, at_line_start
from weblens.shared import broadcast_within_limit, cut_lineage
from weblens.sources.heads import SAMPLE_LINES, file_heads, heads_of
from weblens.sources.text import index_bounds, line_index, number_lines, scan_log_text

_GLOB_SIGNS = re.compile(r"([\\{}\[\]*?])")

# Files that are named one by one in a plan at most.
MOST_NAMED = 10_000


def literal_path(path: str) -> str:
    """A path in which no sign stands for others, for readers that take globs."""
    return _GLOB_SIGNS.sub(r"\\\1", path)


def text_bounds(lines: DataFrame) -> DataFrame:
    """First and last line of each file that is not blank.

    Blank lines around a file's text do not count as part of it. A file of blanks only
    has no row. One row per file leaves each task, however large the file.
    """
    return (
        lines.where(F.col("raw").rlike(r"\S"))
        .groupBy("file_path")
        .agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"))
    )


def sample_lines(lines: DataFrame, bounds: DataFrame) -> DataFrame:
    """The first lines of each file's text, at most `SAMPLE_LINES`, in place.

    Lines are picked by exact (file, line) keys: a small set is broadcast, a large one
    is met by a shuffle that spreads evenly, as no key occurs twice. Lines past every
    sample, nearly all of them, are left out before that.
    """
    last = F.least("last_line", F.col("first_line") + (SAMPLE_LINES - 1))
    keys = bounds.select(
        "file_path", "first_line", F.explode(F.sequence("first_line", last)).alias("line_no")
    )
    deepest = keys.agg(F.max("line_no")).scalar()
    near = lines.where(F.col("line_no") <= deepest)
    picked = near.join(broadcast_within_limit(keys), ["file_path", "line_no"])
    return picked.withColumn(
        "raw",
        F.when(
            F.col("line_no") == F.col("first_line"), F.regexp_replace("raw", r"^\s+", "")
        ).otherwise(F.col("raw")),
    )


def detect_format(lines: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Format of each file: the first whose pattern fits half of the sample.

    Takes `(file_path, line_no, raw)`, returns `(file_path, format, first_line,
    last_line)`. Pass `bounds` (see `text_bounds`) when they are known already, as they
    are for scanned text. Lines blank inside the text count as misses.
    """
    bounds = cut_lineage(text_bounds(lines)) if bounds is None else bounds
    hits = [
        F.count_if(F.col("raw").rlike(at_line_start(f.pattern))).alias(name)
        for name, f in FORMATS.items()
        if f.pattern
    ]
    counts = (
        sample_lines(lines, bounds)
        .groupBy("file_path")
        .agg(F.count("*").alias("sampled"), F.min("first_line").alias("first_line"), *hits)
    )
    chosen = F.coalesce(
        *[
            F.when(2 * F.col(name) >= F.col("sampled"), name)
            for name, f in FORMATS.items()
            if f.pattern
        ],
        F.lit(GENERIC.name),
    )
    ends = bounds.select("file_path", "last_line")
    return counts.join(ends, "file_path").select(
        "file_path", chosen.alias("format"), "first_line", "last_line"
    )


def formats_of_heads(heads: DataFrame) -> DataFrame:
    """`(file_path, format, smooth)` by the rule of `detect_format`, out of files' first lines.

    Takes what `sources.file_heads` returns; files of blanks have no row. Nothing is shuffled.
    """
    found = heads.where(F.col("head").isNotNull() & (F.size("head") > 0))
    return found.select("file_path", _format_of("head").alias("format"), "smooth")


def _format_of(head: str) -> Column:
    lines = F.size(head)
    return F.coalesce(
        *[
            F.when(2 * F.size(F.filter(head, _fits(f.pattern))) >= lines, name)
            for name, f in FORMATS.items()
            if f.pattern
        ],
        F.lit(GENERIC.name),
    )


def detect_heads(
    spark: SparkSession, path: str | list[str], glob: str | None = None
) -> DataFrame:
    """`(file_path, format, smooth)` of the files under `path`, from a few KB of each.

    Files that workers cannot open are told by `detect_format`, which reads them whole.
    """
    heads = file_heads(spark, path, glob)
    found = formats_of_heads(heads)
    closed = heads.where("head IS NULL").select("file_path").limit(MOST_NAMED + 1).collect()
    if closed:
        names = [row.file_path for row in closed]
        whole = _formats_of_text(spark, path, glob, names if len(names) <= MOST_NAMED else None)
        found = found.unionByName(whole.join(found, "file_path", "left_anti"))
    return cut_lineage(found)


def _formats_of_text(spark, path, glob, names: list[str] | None) -> DataFrame:
    """`(file_path, format, smooth)` of the named files, by reading them whole."""
    here = F.col("_metadata.file_path").isin(names) if names is not None else None
    scan = scan_log_text(spark, path, glob, here)
    index = line_index(scan)
    whole = detect_format(number_lines(scan, index), index_bounds(index))
    smooth = F.lit(None).cast("boolean").alias("smooth")
    return whole.select("file_path", "format", smooth)


def told_files(files: DataFrame, count: int) -> DataFrame:
    """`(file_path, path, length, lines, format, smooth)` of files listed as `list_files` does.

    Works on streams of files, for `count` see `heads_of`. `lines` is how many lines tell the
    format: none in a file of blanks, NULL in one that workers cannot open.
    """
    heads = heads_of(files, count).withColumn("lines", F.when(F.col("head").isNotNull(), F.size("head")))
    told = F.when(F.col("lines") > 0, _format_of("head")).alias("format")
    return heads.select("file_path", "path", "length", "lines", told, "smooth")


def formats_of_told(spark: SparkSession, files: list[Row]) -> list[Row]:
    """`detect_heads` of a bounded number of files, out of rows of `told_files`."""
    found = [f for f in files if f.format]
    closed = [literal_path(f.path) for f in files if f.lines is None]
    if closed:
        found += _formats_of_text(spark, closed, None, None).collect()
    return found


def _fits(pattern: str):
    return lambda line: line.rlike(at_line_start(pattern))
