"""Stored tables whose rows are found by key without a scan.

Rows are bucketed by a hash of the key, sorted by it within each file, and the files carry
Bloom filters. A look-up by some keys opens the files of their buckets only, and of those the
row groups that may hold a key; a look-up by very many keys, or a join on the key, moves the
keys to the rows. Buckets are told by file names, so a table is opened again from its folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Up to so many different keys go into the plan as values.
MOST_NAMED_KEYS = 10_000


def _quoted(*names: str) -> str:
    return ".".join("`" + name.replace("`", "``") + "`" for name in names)


def write_keyed_table(
    table: DataFrame, name: str, path: str, key: str, buckets: int = 64
) -> None:
    """Write `table` to `path`, bucketed and sorted by `key`, and enter it as `name`.

    Keys meet by a rebalance, which splits a bucket that is too large for one task: a key held
    by a third of the rows gets several files of its bucket. Choose `buckets` for files of some
    hundred MB. Rows without a key are kept, in one bucket.
    """
    rows = table.hint("rebalance", F.col(_quoted(key)))
    (
        rows.write.format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .option("parquet.bloom.filter.enabled#" + key, "true")
        .mode("overwrite")
        .saveAsTable(_quoted(name))
    )


def open_keyed_table(
    spark: SparkSession, name: str, path: str, key: str, buckets: int, schema: T.StructType
) -> DataFrame:
    """Enter a table that another session wrote to `path`, and read it."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet"
        f" CLUSTERED BY ({_quoted(key)}) SORTED BY ({_quoted(key)}) INTO {buckets} BUCKETS"
        f" LOCATION '{place}'"
    )
    return spark.table(_quoted(name))


def keyed_lookup(
    table: DataFrame,
    key: str,
    keys: DataFrame | Sequence,
    columns: Sequence[str] | None = None,
    most_named: int = MOST_NAMED_KEYS,
) -> DataFrame:
    """Rows of a keyed table whose `key` is among `keys`, all columns or some.

    The result is that of `table_key_lookup`: a repeated key finds its rows once, NULL finds
    none. A frame of keys is reduced to its different ones; up to `most_named` of them are
    named in the plan, which prunes buckets and row groups, more are joined, where the table
    keeps its buckets and only the keys move.
    """
    if isinstance(keys, DataFrame):
        wanted = keys.select(F.col(_quoted(keys.columns[0])).alias(key)).where(
            F.col(_quoted(key)).isNotNull()
        ).distinct()
        some = [row[0] for row in wanted.limit(most_named + 1).collect()]
        if len(some) > most_named:
            found = table.join(wanted, key, "left_semi")
            return found.select(*columns) if columns else found
        keys = some
    found = table.where(F.col(_quoted(key)).isin([k for k in set(keys) if k is not None]))
    return found.select(*columns) if columns else found
