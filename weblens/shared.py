"""Places and sizes shared by jobs: the common folder and checked broadcasts."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    local = tempfile.mkdtemp(prefix="weblens-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other job uses."""
    return f"{shared_dir(spark)}/weblens/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a small intermediate to the shared folder and read it back.

    A written table outlives lost executors, and its size is known afterwards.
    """
    spark = df.sparkSession
    path = new_shared_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes in a hash table, nested ones with all they hold."""
    held = F.lit(0).cast("bigint")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        held = F.octet_length(value).cast("bigint")
    elif isinstance(kind, T.ArrayType):
        held = F.aggregate(value, held, lambda n, x: n + _value_bytes(x, kind.elementType))
    elif isinstance(kind, T.MapType):
        keys = T.ArrayType(kind.keyType)
        values = T.ArrayType(kind.valueType)
        held = _value_bytes(F.map_keys(value), keys) + _value_bytes(F.map_values(value), values)
    elif isinstance(kind, T.StructType):
        for field in kind.fields:
            held = held + _value_bytes(value.getField(field.name), field.dataType)
    return F.coalesce(held, F.lit(0).cast("bigint")) + 16


def broadcast_within_limit(
    df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Mark `df` for broadcast if its measured size is within the limit.

    The size is counted (bytes of texts, binaries and all elements of nested columns, plus a
    fixed share per value and row), so pass an intermediate that is already written. Above the
    limit the frame comes back unmarked and the join shuffles by key.
    """
    row_bytes = F.lit(32).cast("bigint")
    for field in df.schema.fields:
        name = "`" + field.name.replace("`", "``") + "`"
        row_bytes = row_bytes + _value_bytes(F.col(name), field.dataType)
    measured = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if measured <= limit_bytes else df


def spread(df: DataFrame) -> DataFrame:
    """Share rows among all cores if fewer tasks than cores would read them.

    Parsing is bound by the processor, and a file that cannot be split, such as zipped
    text or one row group, is read by one task. Input with enough splits stays as it is.
    Order columns are values by then, so nothing else changes.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    As `spark-submit --py-files` would do; a package that came in an archive is there already.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(package):
        target = os.path.join(tempfile.mkdtemp(prefix="weblens-"), "weblens")
        root, name = os.path.split(package)
        context.addPyFile(shutil.make_archive(target, "zip", root, name))
    _shipped.add(context.applicationId)
