"""Small tables written a run at a time and merged in levels.

A batch's rows are run `batch` of level 0. Once `FANOUT` neighbouring runs of a level are there,
they are merged into one run of the next level; readers take the highest runs that cover a
batch. So a table of n batches is read from some `FANOUT` * log(n) folders.

The runs below stay, so a batch may come late, or again with other rows: the merged runs that
hold it go first, then its own run is written over, then they are merged anew. A job that dies
in between leaves lower runs, which say the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FANOUT = 8

Merge = Callable[[DataFrame], DataFrame]


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def run_path(path: str, level: int, run: int) -> str:
    return f"{path}/level={level}/run={run}"


def _all_done(spark: SparkSession, path: str, level: int, runs: range) -> bool:
    """Whether these runs were written to their end; no other run is looked at."""
    files, _ = _file_system(spark, path)
    place = spark._jvm.org.apache.hadoop.fs.Path
    # The newest is the likeliest to be missing.
    return all(files.exists(place(f"{run_path(path, level, n)}/_SUCCESS")) for n in reversed(runs))


def _done(spark: SparkSession, path: str, level: int) -> set[int]:
    """Runs of a level that were written to their end."""
    files, place = _file_system(spark, f"{path}/level={level}/run=*/_SUCCESS")
    found = files.globStatus(place) or []
    return {int(f.getPath().getParent().getName().partition("=")[2]) for f in found}


def _remove(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def _levels(spark: SparkSession, path: str) -> list[int]:
    files, place = _file_system(spark, f"{path}/level=*")
    return sorted(int(f.getPath().getName().partition("=")[2]) for f in files.globStatus(place) or [])


def write_run(spark: SparkSession, rows: DataFrame, path: str, batch: int, merge: Merge) -> None:
    """Write or replace the rows of a batch, a group a row, and merge what is complete then."""
    for level in reversed(_levels(spark, path)[1:]):  # the highest first: none outlives its parts
        _remove(spark, run_path(path, level, batch // FANOUT**level))
    rows.coalesce(1).write.mode("overwrite").parquet(run_path(path, 0, batch))
    level, run = 0, batch // FANOUT
    while True:
        parts = range(run * FANOUT, (run + 1) * FANOUT)
        if not _all_done(spark, path, level, parts):
            return
        below = [run_path(path, level, part) for part in parts]
        # Runs are small: one task reads them all, so the merge needs no shuffle.
        merged = merge(spark.read.schema(rows.schema).parquet(*below).coalesce(1))
        level += 1
        merged.write.mode("overwrite").parquet(run_path(path, level, run))
        run //= FANOUT


def covering_runs(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """`(level, run)` of the fewest runs that hold each batch once."""
    out: set[tuple[int, int]] = set()
    levels = _levels(spark, path)
    for level in reversed(levels):
        for run in _done(spark, path, level):
            above = {(up, run // FANOUT ** (up - level)) for up in levels if up > level}
            if not above & out:
                out.add((level, run))
    return sorted(out)


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all batches, in partly merged form."""
    paths = [run_path(path, level, run) for level, run in covering_runs(spark, path)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)
