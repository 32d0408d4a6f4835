"""The first lines of log files, by reading only the first few KB of each.

Files are listed by Spark, and tasks open them by position: a few KB from the start, more only
where ten lines are longer than that, and a few KB from the end, to see whether the text
has blanks around it. Zipped files (`.gz`, `.bz2`, `.deflate`) are unzipped only as far.

Workers reach local paths and what pyarrow opens (`s3`, `gs`, `hdfs` with its library). A file
that they cannot open, or that is zipped otherwise, comes back without a head.
"""

from __future__ import annotations

import bz2
import math
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblens.shared import cut_lineage, ship

# Fixed value: how many lines of a file tell its format.
SAMPLE_LINES = 10
FIRST_READ = 4096
FILES_PER_TASK = 64
MOST_TASKS = 4096
#: Blanks as the line patterns know them.
BLANKS = b" \t\n\x0b\x0c\r"
BLANK_SIGNS = BLANKS.decode()
#: How other libraries name the stores that Spark reaches.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """`(file_path, path, length)` of the files under `path` that hold anything.

    `file_path` is written as text scans write it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select(
        F.col("_metadata.file_path").alias("file_path"), "path", "length"
    )
    return files.where("length > 0")


def _open(path: str):
    scheme, mark, rest = path.partition(":")
    if not mark or scheme == "file":
        return open("/" + rest.lstrip("/") if mark else path, "rb")
    found, inner = pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
    return found.open_input_file(inner)


def _unzipper(path: str):
    """What turns a file's bytes into text, None for plain ones."""
    name = path.lower()
    if name.endswith(".gz"):
        return zlib.decompressobj(wbits=31)
    if name.endswith(".deflate"):
        return zlib.decompressobj()
    if name.endswith(".bz2"):
        return bz2.BZ2Decompressor()
    if name.endswith((".zst", ".lz4", ".snappy", ".lzo", ".xz")):
        raise ValueError("zipped otherwise")
    return None


def clean(raw: bytes) -> str:
    """A line without the bytes that are no UTF-8."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("utf-8", "ignore").replace("�", "")


def first_lines(chunks: Iterable[bytes]) -> list[str]:
    """The first lines of the text in `chunks`, read no further than needed.

    Blank lines before the text do not count, those within do, those after do not.
    """
    sample: list[str] = []
    rest = b""

    def add(raw: bytes) -> bool:
        line = clean(raw)
        if not sample:
            line = line.lstrip(BLANK_SIGNS)
            if line:
                sample.append(line)
            return False
        sample.append(line)
        return len(sample) >= SAMPLE_LINES and bool(line.strip(BLANK_SIGNS))

    for chunk in chunks:
        *lines, rest = (rest + chunk).split(b"\n")
        if any(map(add, lines)):
            return sample[:SAMPLE_LINES]
    add(rest)
    while sample and not sample[-1].strip(BLANK_SIGNS):
        sample.pop()
    return sample[:SAMPLE_LINES]


class _Reader:
    """The bytes of one file, from its start in growing chunks, unzipped if need be."""

    def __init__(self, path: str, length: int):
        self.path, self.length, self.read = path, length, 0
        self.file = _open(path)
        self.first = b""

    def chunks(self) -> Iterator[bytes]:
        unzip, size = _unzipper(self.path), FIRST_READ
        while raw := self.file.read(size):
            self.read += len(raw)
            size *= 2
            if unzip is None:
                self.first = self.first or raw
                yield raw
                continue
            out = unzip.decompress(raw)
            self.first = self.first or out
            if out:
                yield out
            while unzip.eof and unzip.unused_data:  # files zipped one after the other
                more = unzip.unused_data
                unzip = _unzipper(self.path)
                yield unzip.decompress(more)

    def smooth(self) -> bool | None:
        """Whether no blanks but line ends surround the text; None for zipped files."""
        if _unzipper(self.path) is not None:
            return None
        text = self.first.lstrip(b"\n")
        if not text or text[:1] in (b" ", b"\t", b"\x0b", b"\x0c", b"\r") or text[0] >= 0x80:
            return False
        size, end = FIRST_READ, b""
        while True:
            low = max(self.length - size, 0)
            self.file.seek(low)
            end = self.file.read(self.length - low)
            self.read += len(end)
            kept = end.rstrip(b"\n")
            if kept or low == 0:
                return bool(kept) and kept[-1:] not in BLANKS and kept[-1] < 0x80
            size *= 4


HEADS = pa.schema(
    [
        ("file_path", pa.string()),
        ("path", pa.string()),
        ("length", pa.int64()),
        ("head", pa.list_(pa.string())),
        ("smooth", pa.bool_()),
        ("read_bytes", pa.int64()),
    ]
)


def _read_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for file_path, path, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            try:
                reader = _Reader(path, length)
            except (OSError, ValueError, ImportError):  # only Spark reaches it
                rows.append((file_path, path, length, None, None, 0))
                continue
            with reader.file:
                try:
                    head = first_lines(reader.chunks())
                    rows.append((file_path, path, length, head, reader.smooth(), reader.read))
                except (ValueError, zlib.error):  # not zipped as its name says
                    rows.append((file_path, path, length, None, None, reader.read))
        arrays = [
            pa.array(values, field.type)
            for values, field in zip(zip(*rows, strict=True), HEADS, strict=True)
        ] if rows else [pa.array([], field.type) for field in HEADS]
        yield pa.RecordBatch.from_arrays(arrays, schema=HEADS)


def file_heads(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """`(file_path, head, smooth, read_bytes)` of each file under `path` that is not empty.

    `head` has at most `SAMPLE_LINES` lines from the first text on (none in a file of blanks);
    NULL where workers cannot read the file. `smooth` tells that no blanks but line ends stand
    before or after the text; NULL where that is not known. Written to the shared folder.
    """
    files = cut_lineage(list_files(spark, path, glob))
    return cut_lineage(heads_of(files, files.count()).drop("path", "length"))


def heads_of(files: DataFrame, count: int) -> DataFrame:
    """`file_heads` of files given as `list_files` returns them, beside their path and length.

    Not written. `count` tells how many files there are, of a stream how many a batch has at most.
    """
    spark = files.sparkSession
    ship(spark)
    # A row stands for a range read, so tasks are made by the number of rows.
    tasks = min(max(math.ceil(count / FILES_PER_TASK), 1), MOST_TASKS)
    tasks = max(tasks, min(spark.sparkContext.defaultParallelism, count))
    shape = (
        "file_path string, path string, length long, "
        "head array<string>, smooth boolean, read_bytes long"
    )
    # A batch of a stream comes in a split for every few files; a shuffle would cost more.
    listed = files.coalesce(tasks) if files.isStreaming else files.repartition(tasks, "file_path")
    return listed.mapInArrow(_read_heads, shape)
