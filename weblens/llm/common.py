"""What the operators of this folder share.

Rows are told apart by `row_key`: the id and a hash of the text. Repeated rows have one key
and get one result each, equal to each other's. A null id is a key like any other.
"""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblens.shared import ship

# Added to what a frame needs while its rows are worked on; an input has no such columns.
KEY = "__row_key"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or one like it that `df` has no column of, whatever the case of its letters."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(*columns: str) -> Column:
    """128 bits that tell rows apart by the values of `columns`, nulls included."""
    parts = [p for c in columns for p in (F.col(c).isNull(), F.col(c))]
    return F.struct(
        F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(7), *parts).alias("b")
    )


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and everything else as it is, which `lower` does only for ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


#: Arrow's type of a row key, for functions that get and give record batches.
KEY_TYPE = pa.struct([("a", pa.int64()), ("b", pa.int64())])


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """A record batch of row tuples, for functions given to `mapInArrow`."""
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def share(spark: SparkSession, value):
    """`value`, of bounded size, for every Python worker, which can import this package."""
    ship(spark)
    return spark.sparkContext.broadcast(value)


def release_memory() -> None:
    """Give the system back what a worker has freed.

    Arrow's pool and glibc's heap both keep it otherwise, as long as the worker lives: the next
    stage then runs on top of it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
