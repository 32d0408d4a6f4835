"""Parse log files as they arrive, each in its own format.

The stream is one of files, not of lines: a batch is the list of new files. Their formats are
told by their first KB and kept in a table of formats, a folder a batch; their lines are then
read once, in the format of their file. A batch that runs again finds its formats in that table
and overwrites its own folders, so each file's rows count once.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery

from weblens.plans.detect import formats_of_told, literal_path, told_files
from weblens.plans.ingest import read_detected
from weblens.streaming.batches import (
    read_all_batches,
    read_batch,
    start_of_files,
    write_batch,
)
from weblens.streaming.parse import REFRESH

FILES_PER_BATCH = 1_000
BYTES_PER_TASK = 4 * 1024 * 1024

FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
FORMAT_SCHEMA = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("smooth", T.BooleanType()),
    ]
)


def stream_detected(
    spark: SparkSession,
    source: str,
    target: str,
    formats: str,
    checkpoint: str,
    trigger: dict | None = None,
    glob: str | None = None,
    max_files_per_trigger: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Start parsing new files under `source` into `target`, told apart by format.

    `formats` gets `(file_path, format, smooth)` of each batch's files. The names of a batch's
    files pass through the driver, as those of any file stream do, so a batch has at most
    `max_files_per_trigger` of them. Nothing of a file is read by the stream itself.
    """
    # Keeps formats while the rows of the same batch are written.
    beside = ThreadPoolExecutor(1, "formats")
    first = True

    def parse(files: DataFrame, batch_id: int) -> None:
        nonlocal first
        session = files.sparkSession
        told = files.collect()
        # Only the first batch of a run can have run before.
        kept = read_batch(session, formats, batch_id, FORMAT_SCHEMA) if first and told else None
        first = False
        if not told:
            return
        again = kept.collect() if kept is not None else []
        rows = again or formats_of_told(session, told)
        paths = [literal_path(f.path) for f in told]
        logs = read_detected(session, paths, formats=rows, tasks=_tasks(session, told, rows))
        keep = inheritable_thread_target(session)(_write_formats)
        keeping = None if again else beside.submit(keep, session, rows, formats, batch_id)
        try:
            write_batch(logs, target, batch_id)
        finally:
            if keeping:
                keeping.result()

    def start() -> StreamingQuery:
        reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        reader = reader.option("recursiveFileLookup", "true")
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        path = F.col("_metadata.file_path").alias("file_path")
        listed = reader.load(source).select(path, "path", "length").where("length > 0")
        arrived = told_files(listed, max_files_per_trigger)
        return (
            arrived.writeStream.foreachBatch(parse)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or REFRESH))
            .start()
        )

    return start_of_files(spark, checkpoint, start)


def _write_formats(spark: SparkSession, rows: list[Row], path: str, batch_id: int) -> None:
    columns = {name: [r[name] for r in rows] for name in FORMAT_SCHEMA.names}
    known = spark.createDataFrame(pa.table(columns, to_arrow_schema(FORMAT_SCHEMA)))
    write_batch(known.coalesce(1), path, batch_id)


def _tasks(spark: SparkSession, files: list[Row], formats: list[Row]) -> int | None:
    """How many tasks read a batch's smooth files at most; None where they are few.

    A scan has a split a file, and a task with the file that it writes costs as much as some
    hundred KB of text: small files share the tasks that there are cores for.
    """
    smooth = {r.file_path for r in formats if r.smooth}
    lengths = [f.length for f in files if f.file_path in smooth]
    cores = spark.sparkContext.defaultParallelism
    return max(cores, -(-sum(lengths) // BYTES_PER_TASK)) if len(lengths) >= cores else None


def stream_formats(spark: SparkSession, formats: str) -> DataFrame:
    """`(file_path, format, batch_id)` of all files so far."""
    found = read_all_batches(spark, formats, FORMAT_SCHEMA)
    return found.select("file_path", "format", F.col("batch_id"))
