"""Listing of log files."""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblens.shared import cut_lineage, ship
from weblens.sources.heads import SCHEMES

ENTRIES = pa.schema(
    [
        ("name", pa.string()),
        ("path", pa.string()),
        ("type", pa.string()),
        ("size", pa.int64()),
        ("modified", pa.timestamp("us", "UTC")),
        ("entered", pa.bool_()),
    ]
)
ENTRY_SHAPE = "name string, path string, type string, size long, modified timestamp, entered boolean"
MOST_TASKS = 4096
ENTRIES_PER_BATCH = 10_000


def log_file_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Name, path, type, size and change time of each file under `path`; none is opened.

    Listed as a scan, so a folder itself and an empty file, which has nothing to scan, do
    not appear; `list_entries` has them.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        F.substring_index("path", "/", -1).alias("name"),
        "path",
        F.lit("file").alias("type"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def _entries_of(folder: str) -> Iterator[tuple]:
    """What a folder holds, as rows of `ENTRIES`."""
    scheme, mark, rest = folder.partition(":")
    base = folder.rstrip("/")
    if not mark or scheme == "file":
        local = "/" + rest.lstrip("/") if mark else folder
        base = "file:" + local.rstrip("/")
        with os.scandir(local) as found:
            for entry in found:
                linked = entry.is_symlink()
                try:
                    about = entry.stat()
                except FileNotFoundError:  # gone meanwhile, or a link to nothing
                    continue
                within = stat.S_ISDIR(about.st_mode)
                kind = "directory" if within else "file"
                size = 0 if within else about.st_size
                clock = about.st_mtime_ns // 1000
                yield entry.name, f"{base}/{entry.name}", kind, size, clock, within and not linked
        return
    files, inner = pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
    for info in files.get_file_info(pafs.FileSelector(inner)):
        within = info.type == pafs.FileType.Directory
        clock = None if info.mtime_ns is None else info.mtime_ns // 1000
        kind = "directory" if within else "file"
        size = 0 if within else info.size
        yield info.base_name, f"{base}/{info.base_name}", kind, size, clock, within


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        values = zip(*rows, strict=True)
        arrays = [pa.array(v, field.type) for v, field in zip(values, ENTRIES, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=ENTRIES)

    for batch in batches:
        for folder in batch.column(0).to_pylist():
            rows: list[tuple] = []
            for row in _entries_of(folder):
                rows.append(row)
                if len(rows) >= ENTRIES_PER_BATCH:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)


def list_entries(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Name, path, type (`file` or `directory`), size and change time of all under a folder.

    Folders, empty files and files of any name appear; a folder's size is 0. Each level of
    folders is one job, whose tasks list the folders of the level before; only their number
    comes to the driver. Folders behind links are named but not entered. Workers must reach
    the path locally or through pyarrow; a missing folder is an error.
    """
    ship(spark)
    folders, levels = spark.createDataFrame([(path,)], "path string"), []
    n = 1
    while n:
        tasks = min(n, MOST_TASKS)
        level = cut_lineage(folders.repartition(tasks, "path").mapInArrow(_list, ENTRY_SHAPE))
        levels.append(level)
        folders = level.where("entered").select("path")
        n = folders.count() if recursive else 0
    return reduce(DataFrame.unionByName, levels).drop("entered")
