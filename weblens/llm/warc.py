"""Write pages as WARC archives and read records back through a two-level capture index.

Archives are gzip files with a member per record, so a record is one range of its file. A page
whose payload an earlier page has becomes a revisit record, without the payload.

The index has two levels. Captures are sorted by key (the URL with its host reversed) and page
over range partitions, which cut even a key that a third of all pages have; each partition
writes its lines as compressed blocks. The directory holds the first key and the place of each
block. A lookup finds its blocks by binary search in the directory, reads those ranges, finds its
lines by binary search in the block, and reads the ranges of the records.

Tasks write files under names of their own and report them in the rows they return; only
files in the written rows belong to the archive, so tasks may run again or twice.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from weblens.llm.common import batch_of, share
from weblens.shared import (
    broadcast_within_limit,
    cut_lineage,
    new_shared_path,
)

BLOCK_LINES = 1000
PARTITION_LINES = 100_000
DIRECTORY_BYTES = 32 << 20  # of the directory in a driver and its tasks at once
DATE = "2024-01-01T00:00:00Z"
PAGE_URN = "urn:weblens:page:"
RESPONSE, REVISIT = "response", "revisit"
#: Fixed values of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

CAPTURE = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string())]
    + [("start", pa.int64()), ("size", pa.int64())]
)
BLOCK = pa.schema(
    [("key", pa.string()), ("file", pa.string()), ("start", pa.int64()), ("size", pa.int64())]
)
FOUND = pa.schema([("file", pa.string()), ("start", pa.int64()), ("size", pa.int64())])
RECORD = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64())]
    + [("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def capture_key(url: Column) -> Column:
    """`https://a.example.com:80/x?y` as `com,example,a)/x?y`; empty for null.

    Hosts are in lower case; scheme, user, port and fragment are left out.
    """
    url = F.coalesce(url, F.lit(""))
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^#]*)"
    host = F.lower(F.regexp_extract(url, parts, 1))
    surt = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(host == "", url).otherwise(
        F.concat(surt, F.lit(")"), F.regexp_extract(url, parts, 2))
    )


# --- records


def _header(name: str, value: str) -> str:
    clean = value.replace("\r", "%0D").replace("\n", "%0A")
    return f"{name}: {clean}\r\n"


def record_bytes(
    page_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None
) -> bytes:
    """One record; a revisit if it refers to a page, and then without the payload."""
    kind = RESPONSE if refers_to is None else REVISIT
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if kind == RESPONSE else http
    head = "WARC/1.1\r\n" + _header("WARC-Type", kind)
    head += _header("WARC-Record-ID", f"<{PAGE_URN}{'' if page_id is None else page_id}>")
    head += _header("WARC-Date", DATE)
    if url is not None:
        head += _header("WARC-Target-URI", url)
    head += _header("WARC-Payload-Digest", f"sha1:{digest}")
    if kind == REVISIT:
        head += _header("WARC-Profile", PROFILE)
        head += _header("WARC-Refers-To", f"<{PAGE_URN}{refers_to}>")
    head += _header("Content-Type", HTTP_TYPE) + _header("Content-Length", str(len(block)))
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", errors="replace").split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines if ": " in line)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def read_record(raw: bytes) -> tuple:
    """`RECORD` of an uncompressed record; its payload must agree with its headers."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(_headers(http)["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == RESPONSE and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    page = fields["WARC-Record-ID"][1 + len(PAGE_URN) : -1]
    refers = fields.get("WARC-Refers-To")
    return (
        int(page) if page else None,
        fields.get("WARC-Target-URI"),
        size,
        digest,
        kind,
        int(refers[1 + len(PAGE_URN) : -1]) if refers else None,
    )


def _gzip(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _gunzip(raw: bytes) -> bytes:
    return zlib.decompress(raw, 31)


# --- files in the shared folder


class _Writer:
    """Ranges appended to one new file, whose name begins with the partition's number."""

    def __init__(self, folder: str, suffix: str):
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        self.name = f"{TaskContext.get().partitionId():08d}-{uuid.uuid4().hex}{suffix}"
        self.file = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.at = 0

    def add(self, raw: bytes) -> tuple[int, int]:
        self.file.write(raw)
        start, self.at = self.at, self.at + len(raw)
        return start, len(raw)


class _Reader:
    """Range reads; the file last read stays open."""

    def __init__(self, folder: str):
        self.system, self.path = fs.FileSystem.from_uri(folder)
        self.name, self.file = None, None

    def read(self, name: str, start: int, size: int) -> bytes:
        if name != self.name:
            if self.file is not None:
                self.file.close()
            self.name, self.file = name, self.system.open_input_file(f"{self.path}/{name}")
        return self.file.read_at(size, start)


# --- writing


def deduplicated(pages: DataFrame, page_id: str, url: str, html: str, least: int) -> DataFrame:
    """`(page_id, url, payload, refers_to)`; `refers_to` is null for responses."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("sha1"),
        F.octet_length(payload).alias("bytes"),
    )
    # One row per payload that several rows have: few, and a third of all rows may have one.
    copies = (
        rows.where(F.col("bytes") >= least)
        .groupBy("sha1", "bytes")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("sha1", "bytes", "first")
    )
    joined = rows.join(broadcast_within_limit(cut_lineage(copies)), ["sha1", "bytes"], "left")
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    refers_to = F.when(later, F.col("first")).alias("refers_to")
    return joined.select("page_id", "url", "payload", refers_to)


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 0,
) -> DataFrame:
    """Write a record per row into archives in `folder`; returns the written captures.

    Of rows with equal payloads of at least `least` bytes, the one with the smallest id is a
    response and the others revisit it; rows without an id come after all others, and are
    responses if no row with that payload has one. Rows that repeat the smallest id are
    responses all. A null payload is empty. A null URL has no header and the empty key.
    """
    to = share(pages.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            rows = []
            for page, address, payload, refers in zip(*batch.columns, strict=True):
                out = out or _Writer(to.value, ".warc.gz")
                page, address, raw = page.as_py(), address.as_py(), payload.as_py()
                record = record_bytes(page, address, base32_sha1(raw), raw, refers.as_py())
                rows.append((page, address, out.name, *out.add(_gzip(record))))
            yield batch_of(rows, CAPTURE)
        if out:
            out.file.close()

    rows = deduplicated(pages, page_id, url, html, least)
    return cut_lineage(rows.mapInArrow(write, from_arrow_schema(CAPTURE)))


class CaptureIndex:
    """Compressed blocks of sorted capture lines, and the directory of their first keys."""

    def __init__(self, folder: str, directory: DataFrame):
        self.folder = folder
        self.directory = directory

    @classmethod
    def build(
        cls, captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES
    ) -> CaptureIndex:
        to = share(captures.sparkSession, folder)

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, lines, first = None, [], None

            def block():
                raw = _gzip("\n".join(lines).encode())
                return [(first, out.name, *out.add(raw))]

            for batch in batches:
                for row in batch.to_pylist():
                    out = out or _Writer(to.value, ".cdx.gz")
                    if not lines:
                        first = row["key"]
                    place = [row["key"], row["file"], row["start"], row["size"]]
                    lines.append(json.dumps(place))
                    if len(lines) == block_lines:
                        yield batch_of(block(), BLOCK)
                        lines = []
            if lines:
                yield batch_of(block(), BLOCK)
            if out:
                out.file.close()

        keyed = captures.select(
            capture_key(F.col("url")).alias("key"), "page_id", "file", "start", "size"
        )
        partitions = max(1, math.ceil(captures.count() / PARTITION_LINES))
        order = ["key", "page_id", "file", "start"]
        blocks = (
            keyed.repartitionByRange(partitions, *order)
            .sortWithinPartitions(*order)
            .mapInArrow(write, from_arrow_schema(BLOCK))
        )
        return cls(folder, cut_lineage(blocks))

    def lookup(self, keys: DataFrame, limit_bytes: int = DIRECTORY_BYTES) -> DataFrame:
        """`(file, start, size)` of all captures with one of `keys` (a column `key`).

        The directory, a row per block, reaches the tasks in slices within `limit_bytes`.
        Keys are looked up once however often they are given; null keys find nothing.
        """
        keys = keys.select("key").where("key IS NOT NULL").distinct()
        size = self.directory.agg(F.sum(F.octet_length("key") + 120)).first()[0] or 0
        slices = max(1, math.ceil(size / limit_bytes))
        found = None
        for i in range(slices):
            part = self.directory.where(F.pmod(F.xxhash64("file"), F.lit(slices)) == i)
            hits = self._in_blocks(self._blocks_of(keys, part))
            found = hits if found is None else found.unionByName(hits)
        return found

    def _blocks_of(self, keys: DataFrame, directory: DataFrame) -> DataFrame:
        """Which blocks may hold a key: by binary search, the blocks from the last one that
        begins before the key on to the last one that begins with it."""
        # Files are in order by their numbers, also where they begin with equal keys.
        rows = sorted(directory.collect())
        known = share(keys.sparkSession, ([r.key for r in rows], [tuple(r)[1:] for r in rows]))
        schema = pa.schema([("key", pa.string()), *list(BLOCK)[1:]])

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            firsts, places = known.value
            for batch in batches:
                out = []
                for key in batch[0].to_pylist():
                    low = max(0, bisect.bisect_left(firsts, key) - 1)
                    high = bisect.bisect_right(firsts, key)
                    out.extend((key, *places[i]) for i in range(low, high))
                yield batch_of(out, schema)

        return keys.mapInArrow(search, from_arrow_schema(schema))

    def _in_blocks(self, wanted: DataFrame) -> DataFrame:
        folder = share(wanted.sparkSession, self.folder)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reader, at, keys, lines = _Reader(folder.value), None, [], []
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    place = (row["file"], row["start"], row["size"])
                    if place != at:
                        raw = _gunzip(reader.read(*place)).decode()
                        lines = [json.loads(line) for line in raw.split("\n")]
                        keys, at = [line[0] for line in lines], place
                    low = bisect.bisect_left(keys, row["key"])
                    high = bisect.bisect_right(keys, row["key"])
                    out.extend(tuple(line[1:]) for line in lines[low:high])
                yield batch_of(out, FOUND)

        by_block = wanted.repartition("file", "start").sortWithinPartitions("file", "start")
        return by_block.mapInArrow(scan, from_arrow_schema(FOUND))


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """The records at `(file, start, size)`, by range reads in the order of the files."""
    source = share(places.sparkSession, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(source.value)
        for batch in batches:
            ranges = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield batch_of([read_record(_gunzip(reader.read(*r))) for r in ranges], RECORD)

    stretch = (F.col("start") / (32 << 20)).cast("long")
    spread = places.select("file", "start", "size").repartition("file", stretch)
    ordered = spread.sortWithinPartitions("file", "start")
    return ordered.mapInArrow(read, from_arrow_schema(RECORD))


def archive_and_read_back(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 0,
) -> DataFrame:
    """`RECORD` of every row of `pages`: written to archives, indexed, looked up by URL, read.

    Empty pages give no archives and no rows. Other columns are not read.
    """
    spark: SparkSession = pages.sparkSession
    archives, index = new_shared_path(spark, "warc"), new_shared_path(spark, "cdx")
    captures = write_archives(pages, archives, page_id, url, html, least)
    built = CaptureIndex.build(captures, index)
    keys = captures.select(capture_key(F.col("url")).alias("key"))
    return read_records(built.lookup(keys), archives)
