"""Counts over the parsed-log table.

Each is one hash aggregate with map-side partials: a hot key costs one row per task, and
what is shuffled is one row per group. Rows without the grouping key are not counted.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblens import schema as S
from weblens.operators.filters import filter_errors, filter_recent


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def count_by(logs: DataFrame, key: Column, name: str, count: str = "requests") -> DataFrame:
    """Rows per value of `key`, rows without one left out."""
    return (
        logs.select(key.alias(name))
        .where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count("*").alias(count))
    )


def _is_error(levels: Iterable[str]) -> Column:
    return F.col("error_level").isin(list(levels))


def _rate(errors: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(errors, total) * 100, F.lit(0.0))


def _span_days() -> Column:
    return F.extract(F.lit("DAY"), F.max("ts") - F.min("ts")).cast("bigint")


def total_requests(logs: DataFrame) -> DataFrame:
    return logs.agg(F.count("*").alias("total_requests"))


def error_count(logs: DataFrame, levels: Iterable[str] = S.ERROR_LEVELS) -> DataFrame:
    return logs.agg(F.count_if(_is_error(levels)).alias("error_count"))


def error_rate(logs: DataFrame, levels: Iterable[str] = S.ERROR_LEVELS) -> DataFrame:
    """Errors in percent of all rows; 0 when there are none."""
    rate = _rate(F.count_if(_is_error(levels)), F.count("*"))
    return logs.agg(rate.alias("error_rate"))


def time_span_days(logs: DataFrame) -> DataFrame:
    """Whole days between the first and the last clock; NULL without clocks."""
    return logs.agg(_span_days().alias("time_span_days"))


def unique_ips(logs: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct clients: exact, or by a sketch of fixed size when asked for."""
    distinct = F.approx_count_distinct("ip") if approximate else F.count_distinct("ip")
    return logs.agg(distinct.alias("unique_ips"))


def kpi_summary(logs: DataFrame, levels: Iterable[str] = S.ERROR_LEVELS) -> DataFrame:
    """Requests, errors, error rate, span and clients, in one pass."""
    errors = F.count_if(_is_error(levels))
    return logs.agg(
        F.count("*").alias("total_requests"),
        errors.alias("error_count"),
        _rate(errors, F.count("*")).alias("error_rate"),
        (F.count("ts") > 0).alias("has_timestamps"),
        _span_days().alias("time_span_days"),
        F.count_distinct("ip").alias("unique_ips"),
    )


def hourly_traffic(logs: DataFrame) -> DataFrame:
    """Requests per hour; hours without any are absent."""
    return count_by(logs, hour_of(F.col("ts")), "hour")


def minute_traffic(logs: DataFrame) -> DataFrame:
    """Requests per minute."""
    return count_by(logs, minute_of(F.col("ts")), "minute")


def recent_minute_traffic(logs: DataFrame, minutes: int = 5) -> DataFrame:
    """Requests per minute over the last minutes."""
    return minute_traffic(filter_recent(logs, minutes))


def hour_of_day_traffic(logs: DataFrame) -> DataFrame:
    """Requests by hour of the day, 0 to 23."""
    return count_by(logs, F.hour("ts").cast("bigint"), "hour_of_day")


def method_counts(logs: DataFrame) -> DataFrame:
    return count_by(logs, F.col("method"), "method", "n").orderBy(F.desc("n"), "method")


def level_counts(logs: DataFrame) -> DataFrame:
    return count_by(logs, F.col("error_level"), "error_level", "n").orderBy(
        F.desc("n"), "error_level"
    )


def errors_by_hour_level(
    logs: DataFrame, levels: Iterable[str] = S.ERROR_LEVELS
) -> DataFrame:
    """Errors per hour and level."""
    return (
        filter_errors(logs, levels)
        .select(hour_of(F.col("ts")).alias("hour"), "error_level")
        .where(F.col("hour").isNotNull())
        .groupBy("hour", "error_level")
        .agg(F.count("*").alias("n"))
    )


def status_class_breakdown(logs: DataFrame) -> DataFrame:
    """Requests per class of status: 2xx, 3xx, 4xx, 5xx."""
    hundreds = F.floor(F.col("status_code") / 100).cast("string")
    return count_by(logs, F.concat(hundreds, F.lit("xx")), "status_class")
