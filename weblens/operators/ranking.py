"""Top-k lists, shares and orderings.

Top-k runs as an aggregate and `TakeOrderedAndProject`: every task keeps k rows. Ties go
to the smaller key, so results do not depend on how rows are spread.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblens import schema as S
from weblens.operators.filters import filter_errors
from weblens.operators.metrics import count_by, hourly_traffic, method_counts


def top_values(logs: DataFrame, column: str, k: int, count: str = "requests") -> DataFrame:
    """The k most frequent values of a column."""
    counts = count_by(logs, F.col(column), column, count)
    return counts.orderBy(F.desc(count), F.asc(column)).limit(k)


def peak_hours(logs: DataFrame, k: int = 10) -> DataFrame:
    """The busiest hours, with a printable label."""
    return (
        hourly_traffic(logs)
        .orderBy(F.desc("requests"), F.asc("hour"))
        .limit(k)
        .select("hour", F.date_format("hour", "yyyy-MM-dd HH:mm").alias("label"), "requests")
    )


def top_paths(logs: DataFrame, k: int = 10) -> DataFrame:
    return top_values(logs, "path", k)


def top_ips(logs: DataFrame, k: int = 10) -> DataFrame:
    return top_values(logs, "ip", k)


def top_status(logs: DataFrame, k: int = 10) -> DataFrame:
    return top_values(logs, "status_code", k, "n")


def top_error_paths(
    logs: DataFrame, k: int = 10, levels: Iterable[str] = S.ERROR_LEVELS
) -> DataFrame:
    """Paths with most errors."""
    return top_values(filter_errors(logs, levels), "path", k, "errors")


def _share(counts: DataFrame, count: str) -> DataFrame:
    """Add each count's percentage of their sum; an empty list has no sum and no rows."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn("share", F.col(count) * 100.0 / total)


def method_share(logs: DataFrame) -> DataFrame:
    """Requests per method with their percentage."""
    return _share(method_counts(logs), "n")


def status_share(logs: DataFrame, k: int = 10) -> DataFrame:
    """The most frequent statuses with their percentage among themselves."""
    return _share(top_status(logs, k), "n")


def sort_logs(logs: DataFrame, by: str, ascending: bool = True) -> DataFrame:
    """All rows by one column, missing values last, equal ones in file order.

    A range-partitioned sort. File order joins the sort key, so a value held by a large
    part of the rows still spreads over many ranges.
    """
    first = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    return logs.orderBy(first, *S.file_order(logs))
