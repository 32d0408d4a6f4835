"""Entry numbers: the position of each kept row in its file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weblens import schema as S
from weblens.shared import broadcast_within_limit, cut_lineage

CHUNK_LINES = 1 << 17


def number_entries(logs: DataFrame, name: str = "entry_number") -> DataFrame:
    """Number the rows of each file 1, 2, 3, … in file order, after any filter.

    Rows are numbered within bounded stretches of a file (a fixed span of lines, or of
    rows within a block of a scan) and written; the count of each stretch is read from that table and
    shifts those behind it. So the text is read and parsed once, and a file of any size
    spreads over many tasks.
    """
    order = S.file_order(logs)
    stretch = (
        F.floor((F.col("line_no") - 1) / CHUNK_LINES)
        if order == list(S.EXACT_ORDER)
        else F.struct("block_start", F.floor(F.col("row_id") / CHUNK_LINES).alias("run"))
    )
    within = Window.partitionBy("file_path", "_stretch").orderBy(*order[1:])
    rows = logs.withColumn("_stretch", stretch)
    numbered = cut_lineage(rows.withColumn("_row", F.row_number().over(within)))
    earlier = (
        Window.partitionBy("file_path")
        .orderBy("_stretch")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = numbered.groupBy("file_path", "_stretch").agg(F.max("_row").alias("_n"))
    before = counts.select(
        "file_path", "_stretch", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    return (
        numbered.join(broadcast_within_limit(cut_lineage(before)), ["file_path", "_stretch"])
        .withColumn(name, (F.col("_before") + F.col("_row")).cast("bigint"))
        .select(name, *logs.columns)
    )


def status_sequence(logs: DataFrame) -> DataFrame:
    """Entry number and status of every row."""
    slim = logs.select(*S.file_order(logs), "status_code")
    return number_entries(slim).select("file_path", "entry_number", "status_code")


def project_series(logs: DataFrame) -> DataFrame:
    """Entry number with all columns, for logs that have neither clock nor status."""
    return number_entries(logs)
