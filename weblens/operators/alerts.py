"""Errors that are new since the last look, and the latest errors."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblens import schema as S
from weblens.functions.classify import severity
from weblens.operators.filters import filter_errors

HighWater = datetime | DataFrame | None


def next_high_water(logs: DataFrame) -> DataFrame:
    """Newest clock seen, to hand to the next look; NULL without clocks."""
    return logs.agg(F.max("ts").alias("high_water"))


def _high_water(value: HighWater) -> Column:
    """A high-water as a column; a one-row frame becomes a scalar subquery."""
    if isinstance(value, DataFrame):
        return value.scalar()
    return F.lit(value).cast("timestamp_ntz")


def _is_new(high_water: HighWater, levels: Iterable[str]) -> Column:
    newer = F.col("ts") > _high_water(high_water)
    return F.coalesce(F.col("error_level").isin(list(levels)) & newer, F.lit(False))


def new_errors(
    logs: DataFrame, high_water: HighWater, levels: Iterable[str] = S.ERROR_LEVELS
) -> DataFrame:
    """Errors later than the high-water. None on the first look, when there is no mark."""
    return logs.where(_is_new(high_water, levels))


def error_delta(
    logs: DataFrame, previous: int | DataFrame, levels: Iterable[str] = S.ERROR_LEVELS
) -> DataFrame:
    """Error count with its rise since the previous count; NULL when it did not rise."""
    before = previous.scalar() if isinstance(previous, DataFrame) else F.lit(previous)
    counted = logs.agg(
        F.count_if(F.col("error_level").isin(list(levels))).alias("error_count")
    ).withColumn("previous_count", before.cast("bigint"))
    rise = F.col("error_count") - F.col("previous_count")
    return counted.withColumn("delta", F.when(rise > 0, rise))


def _alert_text(is_new: Column) -> Column:
    message = F.coalesce("message", "raw", F.lit("No message"))
    clock = F.coalesce(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("Unknown time"))
    text = F.concat("error_level", F.lit(" ["), clock, F.lit("]: "), message)
    return F.when(is_new, F.concat(F.lit("NEW "), text)).otherwise(text)


def flag_new_errors(
    logs: DataFrame, high_water: HighWater, levels: Iterable[str] = S.ERROR_LEVELS
) -> DataFrame:
    """All rows with `is_new`, a `severity` tag and the text an alert would show."""
    is_new = _is_new(high_water, levels)
    # One projection: after a top-k it becomes part of `TakeOrderedAndProject`.
    return logs.select(
        "*",
        is_new.alias("is_new"),
        severity(F.col("error_level"), is_new).alias("severity"),
        _alert_text(is_new).alias("alert"),
    )


def new_error_rows(
    logs: DataFrame, high_water: HighWater, levels: Iterable[str] = S.ERROR_LEVELS
) -> DataFrame:
    """The new errors with severity and alert text."""
    return flag_new_errors(new_errors(logs, high_water, levels), high_water, levels)


def latest_errors(
    logs: DataFrame,
    k: int = 10,
    high_water: HighWater = None,
    levels: Iterable[str] = S.ERROR_LEVELS,
) -> DataFrame:
    """The last k errors by place in the files, oldest first, new ones flagged.

    Each task keeps its last k; the order columns of a plain scan are enough.
    """
    order = S.file_order(logs)
    last = filter_errors(logs, levels).orderBy(*[F.desc(c) for c in order]).limit(k)
    return flag_new_errors(last, high_water, levels).orderBy(*order)
