"""Tables written one folder per micro-batch.

A batch that is run again after a failure overwrites its own folder, so every batch
counts once. State a batch needs is read from the folder of the one before.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch_id"
SHUFFLES = "spark.sql.shuffle.partitions"
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
GATHERING = "spark.sql.streaming.fileSource.log.compactInterval"
CLEANUP = "spark.sql.streaming.fileSource.log.cleanupDelay"
MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
PLAIN_MANAGER = (
    "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
)


def start_narrow(
    spark: SparkSession, partitions: int, start: Callable[[], StreamingQuery]
) -> StreamingQuery:
    """Start a stream whose batches shuffle little, into at most so many parts.

    Streams keep the settings of their start, and a batch of a stream is not planned adaptively:
    each shuffle would have, and each state store commit, the session's number of parts, mostly
    empty ones. A stream that goes on from its checkpoint has the parts that it began with.
    """
    before = int(spark.conf.get(SHUFFLES))
    return start_with(spark, {SHUFFLES: max(1, min(before, partitions))}, start)


def start_of_files(
    spark: SparkSession, checkpoint: str, start: Callable[[], StreamingQuery]
) -> StreamingQuery:
    """Start a stream of many files in many batches, and wait until its source is set up.

    Folders are listed by a few tasks a core, each of many folders, not by a task each. The
    source's log of files is gathered into one file every hundred batches: each time all names so
    far are read and written again, which every ten batches is quadratic over the stream. Parts
    that were gathered go after a minute, as the log's folder is listed every batch. Settings
    that are not Spark's defaults stay.
    """
    wanted = {
        LISTING: ("10000", 4 * spark.sparkContext.defaultParallelism),
        GATHERING: ("10", 100),
        CLEANUP: ("600000ms", "60s"),
    }
    settings = {name: to for name, (usual, to) in wanted.items() if spark.conf.get(name) == usual}
    if spark.conf.get(MANAGER, None) is None and _plain_manager(spark, checkpoint):
        settings[MANAGER] = PLAIN_MANAGER

    def set_up() -> StreamingQuery:
        query = start()  # a source takes its settings from the session, in the stream's thread
        while query.isActive and query.status["message"].startswith("Initializing"):
            time.sleep(0.02)
        return query

    return start_with(spark, settings, set_up)


def _plain_manager(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a checkpoint is on a local disk, and Spark has the manager that suits it.

    There the usual one runs programs (`chmod`, `readlink`) for each of a batch's three files,
    30 ms each. Both write a file beside its place and move it there.
    """
    jvm = spark._jvm
    configured = spark.sparkContext._jsc.hadoopConfiguration()
    if jvm.org.apache.hadoop.fs.Path(checkpoint).getFileSystem(configured).getScheme() != "file":
        return False
    try:
        jvm.org.apache.spark.util.Utils.classForName(PLAIN_MANAGER, False, True)
    except Exception:  # it has another name in other versions
        return False
    return True


def start_with(
    spark: SparkSession, settings: dict[str, int | str], start: Callable[[], StreamingQuery]
) -> StreamingQuery:
    """Start a stream with settings of its own; the session's are as before afterwards."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, str(value))
        return start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}={batch_id}"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(batch_path(path, batch_id))


def read_batch(
    spark: SparkSession, path: str, batch_id: int, schema: T.StructType
) -> DataFrame | None:
    """One batch's rows; None when that batch was never written."""
    if batch_id < 0:
        return None
    try:
        return spark.read.schema(schema).parquet(batch_path(path, batch_id))
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_all_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all batches with their batch number."""
    with_batch = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(with_batch).option("basePath", path).parquet(f"{path}/{BATCH}=*")
