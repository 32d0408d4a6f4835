"""A first look at log files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD_LINES = 10


def log_profile(lines: DataFrame) -> DataFrame:
    """Per file: number of lines, size in characters, and its first lines.

    Takes `(file_path, line_no, raw)`; one pass, at most ten lines kept per file. Each line
    counts with its line end, also a last one without it, as lines do not tell.
    """
    head = F.when(F.col("line_no") <= HEAD_LINES, F.struct("line_no", "raw"))
    in_order = F.array_sort(F.collect_list(head))
    return lines.groupBy("file_path").agg(
        F.count("*").alias("total_lines"),
        F.sum(F.length("raw") + 1).alias("size_chars"),
        F.array_join(F.transform(in_order, lambda line: line["raw"]), "\n").alias("sample"),
    )
