"""Text and CSV out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

# Quotes are doubled and blanks kept, as spreadsheet programs expect.
_CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}


def write_text(lines: DataFrame, path: str, overwrite: bool = False) -> DataFrame:
    """Write the `raw` column as text files; an existing path is an error unless overwritten."""
    mode = "overwrite" if overwrite else "errorifexists"
    lines.select("raw").write.mode(mode).option("lineSep", "\n").text(path)
    reader = lines.sparkSession.read.option("lineSep", "\n")
    return reader.text(path).withColumnRenamed("value", "raw")


def export_csv(logs: DataFrame, folder: str, now: datetime | None = None) -> str:
    """Write rows as CSV with a header under a name that carries the time; returns the path."""
    path = f"{folder.rstrip('/')}/filtered_logs_{(now or datetime.now()):%Y%m%d_%H%M%S}"
    logs.write.options(**_CSV_OPTIONS).csv(path)
    return path


def read_exported_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read an export back."""
    return spark.read.schema(schema).options(**_CSV_OPTIONS).csv(path)
