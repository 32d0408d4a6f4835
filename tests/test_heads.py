"""Formats and rows by the heads of files against reading the files whole."""

import bz2
import gzip
import random
import zlib

import pytest

from tests.compare import spark_rows
from weblens.plans import detect_format, detect_heads, read_detected, read_logs
from weblens.sources import file_heads, index_bounds, line_index, number_lines, scan_log_text
from weblens.sources.heads import first_lines
from weblens.streaming import stream_detected, stream_formats
from weblens.streaming.batches import write_batch

ACCESS = '1.2.3.4 - - [10/Oct/2024:13:55:36 +0000] "GET /a HTTP/1.1" 200 12'
ERROR = "[Wed Oct 11 14:32:52 2024] [error] no such file"
PLAIN = "2024-10-11 14:32:52 WARN slow"
NOW = {"availableNow": True}


def odd_files():
    many = "\n".join([ACCESS] * 3000) + "\n"
    return {
        "plain.log": many.encode(),
        "errors.log": "\n".join([ERROR] * 12).encode(),
        "with space %20[1].log": f"{ERROR}\n{PLAIN}\n{ERROR}\n".encode(),
        "windows.log": "\r\n".join([ACCESS] * 4 + [""]).encode(),
        "before.log": f"\n \n\t\n  {ERROR}\n{ERROR}\nx\n".encode(),
        "after.log": f"{ERROR}\n{ERROR}\nx\ny  \n\n \n".encode(),
        "sparse.log": (ACCESS + "\n" + "\n" * 30 + ACCESS).encode(),
        "three.log": (f"{ACCESS}\nx\n" + "\n" * 9000).encode(),
        "blank.log": b" \n\n\t\n",
        "empty.log": b"",
        "broken.log": b"\xff\xfe\n" + ERROR.encode() + b"\xc3\n" + ERROR.encode(),
        "replaced.log": ("�\n" + PLAIN).encode(),
        "broken_end.log": ERROR.encode() + b"\n" + ERROR.encode() + b" \xff",
        "umlaut.log": "öffnen\nschließenü".encode(),
        "long.log": (ACCESS + " " + "x" * 60_000 + "\n").encode() * 3,
        "long_blank.log": b"\n" * 50_000 + ERROR.encode(),
        "app.log.gz": gzip.compress(many.encode()),
        "parts.gz": gzip.compress(f" {ERROR}\n".encode()) + gzip.compress(ERROR.encode() + b" \n"),
        "app.bz2": bz2.compress(f"{PLAIN}\n{PLAIN}".encode()),
        "app.deflate": zlib.compress(f"{ERROR}\n".encode()),
        "2024-10-11": f"{PLAIN}\n".encode(),
    }


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("logs")
    (path / "deep").mkdir()
    for n, (name, raw) in enumerate(odd_files().items()):
        (path / ("deep" if n % 3 == 0 else ".") / name).write_bytes(raw)
    return str(path)


def whole(spark, path):
    scan = scan_log_text(spark, path)
    index = line_index(scan)
    found = detect_format(number_lines(scan, index), index_bounds(index))
    return {r.file_path: r.format for r in found.collect()}


def test_formats_of_odd_files(spark, folder):
    got = {r.file_path: r.format for r in detect_heads(spark, folder).collect()}
    assert got == whole(spark, folder) and len(got) == len(odd_files()) - 2
    assert {"apache", "error", "generic"} <= set(got.values())


def rows_of(df):
    return spark_rows(df.drop("line_no", "block_start", "row_id"))


def test_rows_of_odd_files(spark, folder):
    assert rows_of(read_detected(spark, folder)) == rows_of(read_logs(spark, folder))


def test_files_that_workers_cannot_open(spark, folder, monkeypatch):
    """Files without a head are told by reading them whole, all of them if there are too many."""
    from weblens.plans import detect, ingest

    want = rows_of(read_logs(spark, folder))
    closed = file_heads(spark, folder).selectExpr(
        "file_path", "CAST(NULL AS ARRAY<STRING>) AS head", "CAST(NULL AS BOOLEAN) AS smooth"
    )
    monkeypatch.setattr(detect, "file_heads", lambda *a: closed)
    assert rows_of(read_detected(spark, folder)) == want
    monkeypatch.setattr(detect, "MOST_NAMED", 2)
    monkeypatch.setattr(ingest, "MOST_NAMED", 2)
    assert rows_of(read_detected(spark, folder)) == want


def test_little_is_read(spark, folder, tmp_path):
    big = tmp_path / "big.log"
    big.write_bytes((ACCESS + "\n").encode() * 200_000)
    found = file_heads(spark, str(tmp_path)).first()
    assert found.smooth and len(found.head) == 10 and found.read_bytes <= 8192
    zipped = tmp_path / "z" / "big.gz"
    zipped.parent.mkdir()
    noise = random.Random(1).randbytes(3_000_000).hex()
    zipped.write_bytes(gzip.compress("\n".join(noise[i : i + 60] for i in range(0, 6_000_000, 60)).encode()))
    found = file_heads(spark, str(zipped)).first()
    assert found.smooth is None and len(found.head) == 10 and found.read_bytes <= 8192


def test_chunks_do_not_matter():
    rng = random.Random(3)
    for _ in range(300):
        lines = rng.choices(["", " ", "x", " y ", "é" * 5, "\r"], k=rng.randrange(0, 25))
        raw = "\n".join(lines).encode()
        text = raw.decode()
        numbers = [i for i, line in enumerate(text.split("\n")) if line.strip(" \r")]
        want = text.split("\n")[numbers[0] : numbers[-1] + 1][:10] if numbers else []
        want = [want[0].lstrip(" \r"), *want[1:]] if want else []
        size = rng.choice([1, 2, 7, 100])
        assert first_lines(raw[i : i + size] for i in range(0, len(raw), size)) == want


def test_no_files(spark, tmp_path):
    (tmp_path / "empty.log").write_bytes(b"")
    assert detect_heads(spark, str(tmp_path)).count() == 0
    assert read_detected(spark, str(tmp_path)).count() == 0


def start(spark, folder, tmp_path, **more):
    target, formats = str(tmp_path / "t"), str(tmp_path / "f")
    stream_detected(spark, folder, target, formats, str(tmp_path / "cp"), NOW, **more).awaitTermination()
    return target, formats


def test_stream_of_mixed_formats(spark, folder, tmp_path):
    target, formats = start(spark, folder, tmp_path, max_files_per_trigger=4)
    got = spark.read.parquet(target).drop("batch_id")
    assert rows_of(got) == rows_of(read_logs(spark, folder))
    kept = stream_formats(spark, formats).collect()
    assert {r.file_path: r.format for r in kept} == whole(spark, folder)
    assert len({r.batch_id for r in kept}) > 3


def test_a_repeated_batch_uses_the_formats_kept(spark, folder, tmp_path):
    target, formats = start(spark, folder, tmp_path, max_files_per_trigger=9)
    before = rows_of(spark.read.parquet(target))
    commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last = commits[-1]
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    start(spark, folder, tmp_path, max_files_per_trigger=9)
    assert rows_of(spark.read.parquet(target)) == before
    # The formats of the batch are taken from the table, not told anew.
    n = int(last.name)
    kept = spark.read.parquet(f"{formats}/batch_id={n}")
    write_batch(spark.createDataFrame([(r.file_path, "generic", r.smooth) for r in kept.collect()], kept.schema), formats, n)
    commit = tmp_path / "cp" / "commits" / last.name
    commit.unlink()
    commit.with_name(f".{commit.name}.crc").unlink(missing_ok=True)
    start(spark, folder, tmp_path, max_files_per_trigger=9)
    got = spark.read.parquet(f"{target}/batch_id={n}").select("format").distinct().collect()
    assert [r.format for r in got] == ["generic"]


def test_stream_batches_run_few_jobs(spark, tmp_path, monkeypatch):
    """Files are listed once, and heads, formats and rows are a job or two each, not written twice."""
    from weblens import shared
    from weblens.plans import detect, parse

    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(3):
        (folder / f"[{n}] a.log").write_text(f"2024-01-01 10:00:0{n} INFO hello\n" * 3)
    (folder / "blank.log").write_text(" \n\n")
    written = []
    for module in (detect, parse):
        monkeypatch.setattr(module, "cut_lineage", lambda df: written.append(df) or shared.cut_lineage(df))
    target, formats = str(tmp_path / "logs"), str(tmp_path / "formats")
    query = stream_detected(spark, str(folder), target, formats, str(tmp_path / "cp"), {"availableNow": True})
    query.awaitTermination()
    assert not written
    assert spark.read.parquet(target).count() == 9
    assert {r.format for r in stream_formats(spark, formats).collect()} == {"generic"}
    assert stream_formats(spark, formats).count() == 3


def test_stream_batches_of_small_files_are_three_jobs_and_few_tasks(spark, tmp_path):
    """Heads, formats and rows; small files share the tasks that there are cores for."""
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(24):
        (folder / f"{n}.log").write_text([ACCESS, ERROR, PLAIN][n % 3] + "\n")
    target, formats = str(tmp_path / "t"), str(tmp_path / "f")
    query = stream_detected(
        spark, str(folder), target, formats, str(tmp_path / "cp"), NOW, max_files_per_trigger=12
    )
    query.awaitTermination()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(query.runId)) <= 2 * 3
    cores = spark.sparkContext.defaultParallelism
    for batch in (0, 1):
        assert len(list((tmp_path / "t" / f"batch_id={batch}").glob("part-*"))) <= cores
    assert rows_of(spark.read.parquet(target).drop("batch_id")) == rows_of(read_logs(spark, str(folder)))


def test_settings_of_a_stream_of_files(spark, tmp_path):
    """The source has them, the session does not keep them, and its own ones stay."""
    from weblens.streaming import batches as B

    names = (B.LISTING, B.GATHERING, B.CLEANUP, B.MANAGER)
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(12):
        (folder / f"{n}.log").write_text(PLAIN + "\n")
    before = [spark.conf.get(name, None) for name in names]
    start(spark, str(folder), tmp_path, max_files_per_trigger=1)
    assert [spark.conf.get(name, None) for name in names] == before
    log = tmp_path / "cp" / "sources" / "0"
    assert (log / "11").exists() and not list(log.glob("*.compact"))
    spark.conf.set(B.GATHERING, "4")
    try:
        start(spark, str(folder), tmp_path / "own", max_files_per_trigger=1)
        assert spark.conf.get(B.GATHERING) == "4"
    finally:
        spark.conf.unset(B.GATHERING)
    assert (tmp_path / "own" / "cp" / "sources" / "0" / "3.compact").exists()


def test_formats_half_kept_are_told_again(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.log").write_text(ERROR + "\n")
    (tmp_path / "f" / "batch_id=0" / "_temporary").mkdir(parents=True)
    target, formats = start(spark, str(folder), tmp_path)
    assert [r.format for r in spark.read.parquet(target).collect()] == ["error"]
    assert [r.format for r in stream_formats(spark, formats).collect()] == ["error"]


def test_formats_of_few_files_by_name(spark, lines, monkeypatch):
    """Named formats give the rows that a table of formats gives, looked up or joined."""
    from weblens.plans import parse

    odd = 'b "quoted" \\ü,{}.log'
    texts = {"a.log": [ACCESS, "x", ""], odd: [ERROR, PLAIN], "c'.log": [PLAIN], "none.log": ["y z"]}
    raw = lines(texts)
    for named in (
        {"a.log": "apache", odd: "error", "c'.log": "generic"},
        {"a.log": "apache"},
        {},
    ):
        table = spark.createDataFrame(list(named.items()), "file_path string, format string")
        want = spark_rows(parse.parse_logs(raw, formats=table))
        assert spark_rows(parse.parse_logs(raw, formats=named)) == want
        with monkeypatch.context() as patch:
            patch.setattr(parse, "MOST_IN_PLAN", 0)
            assert spark_rows(parse.parse_logs(raw, formats=named)) == want
