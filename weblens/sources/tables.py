"""Rows of stored tables, by key or by condition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_key_lookup(
    table: DataFrame,
    key: str,
    keys: DataFrame | Sequence,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows whose `key` is among `keys`, all columns or some.

    A short list becomes a pushed-down filter. A frame of keys is reduced to distinct
    keys before the semi-join, so a key repeated often costs one row per task.
    """
    if isinstance(keys, DataFrame):
        wanted = keys.select(F.col(keys.columns[0]).alias(key)).distinct()
        found = table.join(wanted, key, "left_semi")
    else:
        found = table.where(F.col(key).isin(list(keys)))
    return found.select(*columns) if columns else found


def table_scan_filter(table: DataFrame, condition: str | Column | None = None) -> DataFrame:
    """The whole table, or the rows that meet a condition."""
    return table if condition is None else table.where(condition)
