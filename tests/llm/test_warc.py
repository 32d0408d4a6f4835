"""Archives written and read back, against a brute-force rule and the file format."""

import base64
import gzip
import hashlib

import pytest
from pyarrow import fs

from weblens.llm import warc
from weblens.shared import new_shared_path

ROWS = [
    (5, "http://A.example.com/x", "hi"),
    (3, "http://a.example.com/x", "hi"),
    (3, "http://a.example.com/x", "hi"),
    (None, None, "hi"),
    (None, None, None),
    (7, "odd\r\nurl", ""),
    (8, "//user@host:8/p?q#f", "é" * 1000),
    (9, None, "only once"),
    (None, "", "no id"),
    *[(100 + i, "http://hot.example.com/", f"copy {i % 7}") for i in range(60)],
]


def brute(rows, least):
    first = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if page is not None and len(raw) >= least:
            first[raw] = min(first.get(raw, page), page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        seen = first.get(raw)
        revisit = seen is not None and (page is None or page > seen)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        kind = "revisit" if revisit else "response"
        out.append((page, len(raw), digest, kind, seen if revisit else None))
    return sorted(map(str, out))


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(4)


@pytest.mark.parametrize("least", [0, 3])
def test_round_trip(spark, pages, least, monkeypatch):
    monkeypatch.setattr(warc, "PARTITION_LINES", 10)
    extra = pages.selectExpr("*", "'x' AS key", "1 AS size")
    got = warc.archive_and_read_back(extra, least=least).drop("url").collect()
    assert sorted(str(tuple(r)) for r in got) == brute(ROWS, least)


def test_files_are_gzip_members_of_warc_records(spark, pages):
    folder = new_shared_path(spark, "warc")
    captures = warc.write_archives(pages, folder).collect()
    system, path = fs.FileSystem.from_uri(folder)
    whole = {
        name: gzip.decompress(system.open_input_file(f"{path}/{name}").read())
        for name in {c.file for c in captures}
    }
    assert sum(raw.count(b"WARC/1.1\r\n") for raw in whole.values()) == len(ROWS)
    assert all(raw.endswith(b"\r\n\r\n") for raw in whole.values())


def test_lookup_over_many_blocks_and_slices(spark, pages):
    folder, index = new_shared_path(spark, "warc"), new_shared_path(spark, "cdx")
    captures = warc.write_archives(pages, folder)
    built = warc.CaptureIndex.build(captures, index, block_lines=5)
    assert built.directory.count() > 10
    keys = spark.createDataFrame(
        [("com,example,hot)/",), ("com,example,a)/x",), ("com,none)/",), (None,)], "key string"
    )
    for limit in (1 << 20, 300):
        got = warc.read_records(built.lookup(keys, limit), folder)
        assert sorted(r.page_id for r in got.collect()) == [3, 3, 5, *range(100, 160)]


def test_no_pages(spark, pages):
    assert warc.archive_and_read_back(pages.limit(0)).count() == 0


def test_a_damaged_record_is_an_error():
    raw = warc.record_bytes(1, "u", warc.base32_sha1(b"other"), b"payload", None)
    with pytest.raises(ValueError, match="damaged"):
        warc.read_record(raw)
