"""Streams give what the batch operators give, over several batches and after repeats."""

import os
from datetime import datetime, timedelta

import pytest

from weblens import operators as ops
from weblens.plans import parse_logs, read_logs
from weblens.sources.text import stream_log_text
from weblens.streaming import (
    error_delta_by_batch,
    live_minute_traffic,
    read_alerts,
    stream_minute_traffic,
    stream_parse,
    watch_new_errors,
)
from weblens.streaming.batches import write_batch

NOW = {"availableNow": True}
START = datetime(2024, 1, 1, 10)


def line(clock, status=200):
    return f'1.1.1.1 - - [{clock:%d/%b/%Y:%H:%M:%S} +0000] "GET /a HTTP/1.1" {status} 10'


class Folder:
    """A folder of log files; each file written comes as one batch."""

    def __init__(self, path):
        self.path, self.files = path, 0
        path.mkdir()

    def add(self, *lines):
        self.files += 1
        file = self.path / f"{self.files:03}.log"
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + self.files,) * 2)  # files come oldest first

    def stream(self, spark):
        return parse_logs(stream_log_text(spark, str(self.path), max_files_per_trigger=1), "apache")


@pytest.fixture
def folder(tmp_path):
    return Folder(tmp_path / "in")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_parse_stream_is_batch_parse(spark, folder, tmp_path):
    folder.add(line(START), "noise", "")
    folder.add(line(START, 500), "a b c d e")
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream_parse(
            spark, str(folder.path), target, checkpoint, "apache", NOW, max_files_per_trigger=1
        ).awaitTermination()
        return spark.read.parquet(target)

    columns = ["raw", "parse_status", "ts", "status_code", "error_level"]
    batch = lambda: read_logs(spark, str(folder.path), "apache").select(columns)
    assert rows(run().select(columns)) == rows(batch())
    folder.add(line(START, 404))
    assert rows(run().select(columns)) == rows(batch())
    assert rows(run().select(columns)) == rows(batch())  # nothing new, nothing twice


def test_live_traffic_is_recent_traffic(spark, folder, tmp_path):
    target, checkpoint = str(tmp_path / "views"), str(tmp_path / "cp")

    def run():
        stream_minute_traffic(
            folder.stream(spark), target, checkpoint, trigger=NOW
        ).awaitTermination()
        return rows(live_minute_traffic(spark, target))

    def batch():
        return rows(ops.recent_minute_traffic(read_logs(spark, str(folder.path), "apache")))

    folder.add(*[line(START + timedelta(seconds=40 * n)) for n in range(20)])
    assert run() == batch()
    # late but within the view, older than the view, repeated clocks, no clock
    folder.add(*[line(START + timedelta(seconds=s)) for s in (600, 600, 755, 10, 760)], "noise")
    folder.add(line(START + timedelta(minutes=17)), line(START + timedelta(minutes=12)))
    folder.add(line(START + timedelta(minutes=3)), line(START + timedelta(minutes=14)))
    assert run() == batch()
    folder.add(line(START + timedelta(hours=2)))
    assert run() == batch() and len(batch()) == 1


def test_a_late_row_on_the_edge_counts(spark, folder, tmp_path):
    target, checkpoint = str(tmp_path / "views"), str(tmp_path / "cp")
    folder.add(line(START), line(START + timedelta(minutes=5)))
    folder.add(line(START), "noise")
    query = stream_minute_traffic(folder.stream(spark), target, checkpoint, trigger=NOW)
    query.awaitTermination()
    view = live_minute_traffic(spark, target).orderBy("minute").collect()
    assert [r.requests for r in view] == [2, 1]
    # The state of a batch is worked out once, although the batch's counts are used twice.
    first = next(p for p in query.recentProgress if p.numInputRows)
    assert first.stateOperators[0].numRowsUpdated == 2


def watch(spark, folder, tmp_path):
    paths = [str(tmp_path / n) for n in ("alerts", "state", "cp")]
    watch_new_errors(folder.stream(spark), *paths, trigger=NOW).awaitTermination()
    return paths


def test_new_errors_by_batch(spark, folder, tmp_path):
    minute = lambda n: START + timedelta(minutes=n)
    folder.add(line(minute(0)), line(minute(5), 500))
    folder.add(line(minute(5), 500), line(minute(6), 404), line(minute(7)))
    folder.add(line(minute(6), 503), "noise")
    folder.add(line(minute(8), 503))
    alerts, state, _ = watch(spark, folder, tmp_path)
    schema = ops.new_error_rows(folder.stream(spark), None).schema
    got = rows(read_alerts(spark, alerts, schema).select("batch_id", "ts", "severity"))
    assert got == [(1, minute(6), "new"), (3, minute(8), "new")]
    deltas = error_delta_by_batch(spark, state).orderBy("batch_id")
    assert [tuple(r) for r in deltas.select("error_count", "delta").collect()] == [
        (1, 1), (3, 2), (4, 1), (5, 1)
    ]


def test_a_repeated_batch_ends_the_same(spark, folder, tmp_path):
    folder.add(line(START, 500))
    folder.add(line(START + timedelta(minutes=1), 500))
    alerts, state, checkpoint = watch(spark, folder, tmp_path)
    before = rows(error_delta_by_batch(spark, state))
    # Forget that the last batch was done: the next run does it again.
    commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last = commits[-1]
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    watch(spark, folder, tmp_path)
    assert rows(error_delta_by_batch(spark, state)) == before
    schema = ops.new_error_rows(folder.stream(spark), None).schema
    assert read_alerts(spark, alerts, schema).count() == 1


def test_views_do_not_mix_with_an_older_ring(spark, folder, tmp_path):
    target = str(tmp_path / "views")
    stale = spark.sql(
        "SELECT 7L AS view_id, timestamp'2030-01-01 00:00:00' AS ts_event, 9L AS requests"
    )
    write_batch(stale, target, 0)
    write_batch(stale, target, 719)
    folder.add(line(START))
    stream_minute_traffic(
        folder.stream(spark), target, str(tmp_path / "cp"), trigger=NOW
    ).awaitTermination()
    newest = spark.read.parquet(target).where("view_id = 0").select("ts_event").distinct()
    assert [r.ts_event for r in newest.collect()] == [START]
