"""Text and CSV out, and the stored table."""

import csv
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from weblens import sinks
from weblens.plans import load_logs, parse_logs, store_logs
from tests.compare import plan_of

RAW = [
    '1.1.1.1 - - [01/Jan/2024:10:00:00 +0000] "GET /a,b HTTP/1.1" 200 10 "say ""hi"""',
    '1.1.1.1 - - [02/Jan/2024:10:00:00 +0000] "GET / HTTP/1.1" 404 - \r',
    "  noise, \\ and \"quotes\" ",
]


def test_write_text(lines, tmp_path):
    path = str(tmp_path / "out")
    assert sorted(r.raw for r in sinks.write_text(lines(RAW), path).collect()) == sorted(RAW)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        sinks.write_text(lines(RAW), path)
    assert sinks.write_text(lines(RAW[:1]), path, overwrite=True).count() == 1


def test_csv_comes_back_whole(spark, lines, tmp_path):
    logs = parse_logs(lines(RAW), "apache").drop("ts_utc")
    path = sinks.export_csv(logs, str(tmp_path), datetime(2024, 1, 2, 3, 4, 5))
    assert path.endswith("/filtered_logs_20240102_030405")
    back = sinks.read_exported_csv(spark, path, logs.schema)
    # CSV has one empty cell for both a missing and an empty text.
    written = [tuple(None if v == "" else v for v in row) for row in logs.collect()]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(written, key=str)


def test_csv_reads_elsewhere(lines, tmp_path):
    logs = parse_logs(lines(RAW), "apache").select("line_no", "raw", "status_code").coalesce(1)
    path = sinks.export_csv(logs, str(tmp_path))
    (part,) = [p for p in tmp_path.glob("filtered_logs_*/part-*.csv")]
    with open(part, newline="", encoding="utf-8") as file:
        header, *rows = csv.reader(file, lineterminator="\n")
    assert path and header == ["line_no", "raw", "status_code"]
    assert [r[1] for r in sorted(rows)] == RAW


@pytest.mark.parametrize("rebalance", [False, True])
def test_store_by_day(spark, lines, tmp_path, rebalance):
    logs = parse_logs(lines(RAW), "apache")
    path = str(tmp_path / "logs")
    store_logs(logs, path, rebalance=rebalance)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        store_logs(logs, path)
    stored = load_logs(spark, path)
    assert stored.columns == logs.columns
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, logs.collect()), key=str)
    one_day = load_logs(spark, path, date(2024, 1, 2), date(2024, 1, 2))
    assert [r.status_code for r in one_day.collect()] == [404]
    assert "PartitionFilters: [isnotnull(log_date" in plan_of(one_day)


def test_unparsed_rows_are_stored_too(spark, lines, tmp_path):
    path = str(tmp_path / "logs")
    store_logs(parse_logs(lines([*RAW, "noise"]), "apache"), path)
    assert load_logs(spark, path).where(F.col("parse_status") == "unparsed").count() == 1
