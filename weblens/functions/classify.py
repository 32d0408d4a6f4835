"""Level and status rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weblens import schema as S


def status_level(status: Column) -> Column:
    """Level of a numeric HTTP status; a status too large for int is a server error."""
    return (
        F.when(status < 300, S.SUCCESS)
        .when(status < 400, S.REDIRECT)
        .when(status < 500, S.CLIENT_ERROR)
        .otherwise(S.SERVER_ERROR)
    )


def level_status(level: Column) -> Column:
    """HTTP-like status that stands for an error-log level."""
    name = F.upper(level)
    return (
        F.when(name.contains("ERROR") | name.contains("CRIT"), 500)
        .when(name.contains("WARN"), 400)
        .otherwise(200)
    )


def keyword_level(text: Column) -> Column:
    """Level of a free-form line, by words found anywhere in it."""
    name = F.upper(text)
    return (
        F.when(name.rlike("ERROR|CRITICAL|FATAL"), S.ERROR)
        .when(name.contains("WARN"), S.WARNING)
        .otherwise(S.INFO)
    )


def severity(level: Column, is_new: Column) -> Column:
    """Row tag for listings: new errors first, then by level."""
    return (
        F.when(is_new, "new")
        .when(level.isin(S.ERROR, S.SERVER_ERROR), "error")
        .when(level == S.CLIENT_ERROR, "warning")
        .otherwise("none")
    )
