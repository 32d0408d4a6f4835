"""Log text as lines, in file order, without shuffling the text."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weblens.shared import broadcast_within_limit, cut_lineage

# How many tasks a scan is cut for at least, whatever the cluster. Spark would take the cores
# there are just then, and two scans of one text could be split differently. From some GB on the
# largest size of a split decides; below, more tasks would cost more than they read.
SPLITS = "spark.sql.files.minPartitionNum"
LEAST_SPLITS = "32"


def pin_splits(spark: SparkSession) -> None:
    """Cut files alike from now on, unless the session says how already."""
    if spark.conf.get(SPLITS, None) is None:
        spark.conf.set(SPLITS, LEAST_SPLITS)


def valid_text(value: Column) -> Column:
    """Text with undecodable bytes left out."""
    cleaned = F.replace(F.make_valid_utf8(value), F.lit("�"), F.lit(""))
    return F.when(F.is_valid_utf8(value), value).otherwise(cleaned)


def _clean_lines(reader, path: str | list[str], glob: str | None) -> DataFrame:
    # Lines end at "\n" only; a carriage return stays part of its line.
    reader = reader.option("lineSep", "\n").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path)


def scan_log_text(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """Lines of every file under `path` (file, folder or glob, any file system).

    Whatever their names: rotated, dated and zipped logs count. `glob` picks files by name.
    `(file_path, block_start, row_id, raw)`: the last two order lines within a file, as
    a block is read by one task. Nothing is shuffled. `keep` is a condition on `_metadata`;
    files that fail it are not opened.
    """
    pin_splits(spark)
    lines = _clean_lines(spark.read, path, glob)
    lines = lines if keep is None else lines.where(keep)
    return lines.select(*_scanned(spark.sparkContext.applicationId))


@lru_cache(maxsize=4)
def _scanned(app: str) -> tuple[Column, ...]:
    """What a scan selects, made once an application: streams scan every batch."""
    return (
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        valid_text(F.col("value")).alias("raw"),
    )


def line_index(scan: DataFrame) -> DataFrame:
    """Where each block of a scan starts, in lines; one small row per file block.

    Reads the text once, keeping only row ids; each task sends one row per block. Also
    carries the first and last line of each file's text. Written to the shared folder.
    """
    row_id, n_lines = F.col("row_id"), F.col("n_lines")
    text_row = F.when(F.col("raw").rlike(r"\S"), row_id)
    blocks = scan.groupBy("file_path", "block_start").agg(
        F.min(row_id).alias("first_row"),
        F.count("*").alias("n_lines"),
        F.min(text_row).alias("first_text"),
        F.max(text_row).alias("last_text"),
    )
    in_file = Window.partitionBy("file_path")
    earlier = in_file.orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    line = F.col("lines_before") - F.col("first_row") + 1
    index = (
        blocks.withColumn("lines_before", F.coalesce(F.sum(n_lines).over(earlier), F.lit(0)))
        .withColumn("first_line", F.min(line + F.col("first_text")).over(in_file))
        .withColumn("last_line", F.max(line + F.col("last_text")).over(in_file))
        .drop("first_text", "last_text")
    )
    return cut_lineage(index)


def index_bounds(index: DataFrame) -> DataFrame:
    """First and last line of text per file, out of a line index."""
    return (
        index.where(F.col("first_line").isNotNull())
        .select("file_path", "first_line", "last_line")
        .distinct()
    )


def number_lines(scan: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Replace scan positions by `line_no`, the exact 1-based line in the file.

    The index is broadcast when its measured size allows; otherwise lines meet it by a
    shuffle on (file, block), groups that are no larger than one file block. Both reads
    must split files alike, which the row check proves: a line outside its block fails
    the job instead of getting a wrong number.
    """
    index = line_index(scan) if index is None else index
    offsets = broadcast_within_limit(
        index.select("file_path", "block_start", "first_row", "n_lines", "lines_before")
    )
    in_block = F.col("row_id") - F.col("first_row") + 1
    line_no = F.when(
        in_block.between(1, F.col("n_lines")), F.col("lines_before") + in_block
    ).otherwise(F.raise_error(F.lit("files were split differently when they were indexed")))
    return scan.join(offsets, ["file_path", "block_start"], "left").select(
        "file_path", line_no.cast("bigint").alias("line_no"), "raw"
    )


def stream_log_text(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Lines of log files as they arrive under `path`: `(file_path, raw)`."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _clean_lines(reader, path, glob).select(
        F.col("_metadata.file_path").alias("file_path"), valid_text(F.col("value")).alias("raw")
    )
