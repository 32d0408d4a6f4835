"""Row filters over the parsed-log table."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblens import schema as S

# Columns a search looks at, and those of them that are pieces of the raw line.
SEARCHED = (
    "raw", "error_level", "ts", "status_code", "message", "timestamp_raw", "ip", "method",
    "path", "protocol", "status_raw", "size_raw",
)
RAW_PIECES = {
    "message", "timestamp_raw", "ip", "method", "path", "protocol", "status_raw", "size_raw"
}


def date_bounds(logs: DataFrame) -> DataFrame:
    """First and last calendar day."""
    return logs.agg(
        F.to_date(F.min("ts")).alias("min_date"), F.to_date(F.max("ts")).alias("max_date")
    )


def with_clock_if_any(logs: DataFrame) -> DataFrame:
    """What a full-span date filter keeps: rows with a clock, or all if no row has one."""
    clocked = logs.where(F.col("ts").isNotNull()).select(F.lit(1).alias("one")).limit(1)
    any_clock = clocked.agg(F.count("one") > 0).scalar()
    return logs.where(F.col("ts").isNotNull() | ~any_clock)


def filter_date_range(
    logs: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Rows between two calendar days, both included; rows without a clock are left out.

    Stated as a range of `ts`, so it reaches stored files. No bound at all filters nothing.
    """
    if start is not None:
        logs = logs.where(F.col("ts") >= F.lit(f"{start:%Y-%m-%d}").cast("timestamp_ntz"))
    if end is not None:
        after = end + timedelta(days=1)
        logs = logs.where(F.col("ts") < F.lit(f"{after:%Y-%m-%d}").cast("timestamp_ntz"))
    return logs


def filter_level(logs: DataFrame, levels: Iterable[str] | None = None) -> DataFrame:
    """Rows of the given levels; None keeps all."""
    return logs if levels is None else logs.where(F.col("error_level").isin(list(levels)))


def filter_status(logs: DataFrame, statuses: Iterable[int | None] | None = None) -> DataFrame:
    """Rows of the given statuses; a None among them stands for rows without a status."""
    if statuses is None:
        return logs
    wanted = list(statuses)
    keep = F.col("status_code").isin([s for s in wanted if s is not None])
    if None in wanted:
        keep = keep | F.col("status_code").isNull()
    return logs.where(keep)


def filter_combined(
    logs: DataFrame,
    start: date | None = None,
    end: date | None = None,
    levels: Iterable[str] | None = None,
    statuses: Iterable[int | None] | None = None,
) -> DataFrame:
    """Date, level and status filter together; Catalyst merges them into one."""
    return filter_status(filter_level(filter_date_range(logs, start, end), levels), statuses)


def facet_values(
    logs: DataFrame,
    start: date | None = None,
    end: date | None = None,
    levels: Iterable[str] | None = None,
) -> DataFrame:
    """Values on offer: levels after the date filter, statuses after the level filter too.

    One pass finds the distinct (level, status) pairs; the facets come out of those few.
    """
    pairs = filter_date_range(logs, start, end).select("error_level", "status_code").distinct()
    status = F.col("status_code").cast("string")
    chosen = F.lit(True) if levels is None else F.col("error_level").isin(list(levels))
    facets = F.array(
        F.struct(F.lit("error_level").alias("facet"), F.col("error_level").alias("value")),
        F.struct(
            F.when(chosen, F.lit("status_code")).alias("facet"), F.when(chosen, status).alias("value")
        ),
    )
    return (
        pairs.select(F.inline(facets))
        .where(F.col("facet").isNotNull())
        .distinct()
        .orderBy("facet", F.col("value").cast("string").asc_nulls_last())
    )


def filter_errors(logs: DataFrame, levels: Iterable[str] = S.ERROR_LEVELS) -> DataFrame:
    """Rows whose level counts as an error."""
    return logs.where(F.col("error_level").isin(list(levels)))


def filter_recent(logs: DataFrame, minutes: int = 5) -> DataFrame:
    """Rows of the last minutes before the newest clock, the edge included.

    The newest clock is a scalar subquery: its own small aggregate, then a plain filter.
    """
    newest = logs.agg(F.max("ts").alias("newest"))
    edge = newest.select(F.col("newest") - F.expr(f"INTERVAL {int(minutes)} MINUTES")).scalar()
    return logs.where(F.col("ts") >= edge)


# What a regular expression may hold without ever taking in a line end: anything but
# negated classes, look-arounds, flags, control characters and most escapes.
_ACROSS_LINES = re.compile(r"\[\^|\(\?(?!:)|\\[^dwb\W]|\\[\s]|[\x00-\x1f]")
_PLAIN = re.compile(r"[\w /:,;@%#&=~<>!'\"-]+")


def search_logs(logs: DataFrame, term: str, literal: bool = False) -> DataFrame:
    """Rows where any column, as text, contains the term, whatever its case.

    The term is a regular expression unless `literal`. Missing values never match. A term
    without special characters need not be looked up in columns that repeat part of `raw`.
    Most expressions cannot match across a line end, so one run over the columns, a line
    each, tells the same as a run over every column.
    """
    if not term:
        return logs
    plain = term != "-" and (literal or _PLAIN.fullmatch(term) is not None)
    term = re.escape(term) if literal else term
    names = [c for c in SEARCHED if c in logs.columns and not (plain and c in RAW_PIECES)]
    cells = [F.col(c).cast("string") for c in names]
    if _ACROSS_LINES.search(term):
        return logs.where(reduce(or_, [cell.rlike("(?iud)" + term) for cell in cells]))
    # The joined text comes out of a generator, so that parsing is not repeated in the filter.
    joined = logs.select("*", F.explode(F.array(F.concat_ws("\n", *cells))).alias("_cells"))
    return joined.where(F.col("_cells").rlike("(?iumd)" + term)).drop("_cells")
