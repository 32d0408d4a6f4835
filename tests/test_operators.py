"""Filters, counts, rankings, sequences and alerts on a small parsed table."""

from datetime import date, datetime

import pytest

from tests.compare import plan_of
from weblens import operators as ops
from weblens import schema as S
from weblens.plans import dashboard, parse_logs


def line(clock, path="/a", status=200, ip="1.1.1.1", method="GET"):
    return f'{ip} - - [{clock} +0000] "{method} {path} HTTP/1.1" {status} 10'


@pytest.fixture
def logs(lines):
    return parse_logs(
        lines(
            [
                line("01/Jan/2024:10:00:00"),
                line("01/Jan/2024:10:59:59", "/b", 500, "2.2.2.2", "POST"),
                "noise",
                line("02/Jan/2024:23:54:59", "/b", 404),
                line("02/Jan/2024:23:55:00", "/c", 302, "3.3.3.3"),
                line("02/Jan/2024:23:59:30", "/c", 503),
                line("03/Jan/2024:00:00:00", "/a", 404, "2.2.2.2"),
                '9.9.9.9 - - [01/Jan/2024:11:00:00 +0000] "GET /z" 408 -',
            ]
        ),
        "apache",
    )


@pytest.fixture
def empty(logs):
    return logs.where("false")


def numbers(df):
    return sorted(r.line_no for r in df.collect())


def one(df):
    return tuple(df.first())


def pairs(df):
    return [tuple(r) for r in df.collect()]


def test_date_filter_holds_both_days(logs):
    assert numbers(ops.filter_date_range(logs, date(2024, 1, 1), date(2024, 1, 1))) == [1, 2, 8]
    assert numbers(ops.filter_date_range(logs, date(2024, 1, 2))) == [4, 5, 6, 7]
    assert numbers(ops.filter_date_range(logs, end=date(2024, 1, 2))) == [1, 2, 4, 5, 6, 8]
    assert numbers(ops.filter_date_range(logs)) == list(range(1, 9))


def test_rows_without_clock_stay_only_among_their_like(logs):
    assert numbers(ops.with_clock_if_any(logs)) == [1, 2, 4, 5, 6, 7, 8]
    assert numbers(ops.with_clock_if_any(logs.where("ts IS NULL"))) == [3]


def test_status_and_level_filters(logs):
    assert numbers(ops.filter_status(logs, [404, None])) == [3, 4, 7]
    assert numbers(ops.filter_status(logs, [404])) == [4, 7]
    assert numbers(ops.filter_status(logs, [])) == []
    assert numbers(ops.filter_level(logs, ["INFO", "UNPARSED"])) == [3, 8]
    assert numbers(ops.filter_errors(logs)) == [2, 4, 6, 7]
    chosen = ops.filter_combined(logs, date(2024, 1, 2), None, ["CLIENT_ERROR"], [404])
    assert numbers(chosen) == [4, 7]


def test_date_filter_reaches_stored_files(spark, logs, tmp_path):
    logs.write.parquet(str(tmp_path / "logs"))
    stored = spark.read.parquet(str(tmp_path / "logs"))
    chosen = ops.filter_level(ops.filter_date_range(stored, date(2024, 1, 2)), ["CLIENT_ERROR"])
    plan = plan_of(ops.top_paths(chosen))
    assert "GreaterThanOrEqual(ts" in plan and "EqualTo(error_level,CLIENT_ERROR)" in plan
    assert "ReadSchema: struct<path:string,ts:timestamp_ntz,error_level:string>" in plan


def test_facets(logs):
    got = pairs(ops.facet_values(logs, date(2024, 1, 2), None, ["CLIENT_ERROR"]))
    assert got == [
        ("error_level", "CLIENT_ERROR"), ("error_level", "REDIRECT"),
        ("error_level", "SERVER_ERROR"), ("status_code", "404"),
    ]
    assert ("status_code", None) in pairs(ops.facet_values(logs))


@pytest.mark.parametrize(
    ("term", "found"),
    [
        ("", list(range(1, 9))),
        ("post", [2]),  # any case
        ("unparsed", [3]),  # a column that is not in the line
        ("server_error", [2, 6]),
        ("2024-01-02", [4, 5, 6]),  # the clock as text
        ("^/b$", [2, 4]),  # anchors are those of a column
        ("^GET$", [1, 4, 5, 6, 7, 8]),
        ("nan|none|null|nat", []),  # missing values never match
        (r"5\d3", [6]),
        (r"\b404\b", [4, 7]),
        (r"^[^/]oise$", [3]),  # cannot be tried on all columns at once
        (r"GET\s/z", [8]),
        (r"/z\"\s", [8]),
        ("-", [1, 2, 4, 5, 6, 7, 8]),
        ("^-$", [8]),
    ],
)
def test_search(logs, term, found):
    assert numbers(ops.search_logs(logs, term)) == found


def test_search_modes(logs):
    assert numbers(ops.search_logs(logs, "/a HTTP/1.1", literal=True)) == [1, 7]
    assert numbers(ops.search_logs(logs, "[03/", literal=True)) == [7]
    with pytest.raises(Exception):
        ops.search_logs(logs, "[03/").collect()


def test_recent_rows_and_minutes(logs):
    assert numbers(ops.filter_recent(logs)) == [5, 6, 7]  # five minutes back is included
    assert pairs(ops.recent_minute_traffic(logs).orderBy("minute")) == [
        (datetime(2024, 1, 2, 23, 55), 1), (datetime(2024, 1, 2, 23, 59), 1),
        (datetime(2024, 1, 3), 1),
    ]


def test_kpis(logs, empty):
    got = ops.kpi_summary(logs).first()
    assert (got.total_requests, got.error_count, got.error_rate) == (8, 4, 50.0)
    assert (got.time_span_days, got.unique_ips, got.has_timestamps) == (1, 4, True)
    none = ops.kpi_summary(empty).first()
    assert (none.total_requests, none.error_rate, none.time_span_days) == (0, 0.0, None)
    assert not none.has_timestamps
    assert one(ops.error_rate(empty)) == (0.0,)
    assert one(ops.unique_ips(logs, approximate=True)) == (4,)


def test_traffic(logs):
    hours = dict(pairs(ops.hourly_traffic(logs)))
    assert hours == {
        datetime(2024, 1, 1, 10): 2, datetime(2024, 1, 1, 11): 1,
        datetime(2024, 1, 2, 23): 3, datetime(2024, 1, 3): 1,
    }
    assert dict(pairs(ops.hour_of_day_traffic(logs))) == {0: 1, 10: 2, 11: 1, 23: 3}
    assert dict(pairs(ops.status_class_breakdown(logs))) == {"2xx": 1, "3xx": 1, "4xx": 3, "5xx": 2}
    assert pairs(ops.method_counts(logs)) == [("GET", 6), ("POST", 1)]
    assert (datetime(2024, 1, 2, 23), "CLIENT_ERROR", 1) in pairs(ops.errors_by_hour_level(logs))


def test_rankings_break_ties_by_key(logs):
    assert pairs(ops.top_paths(logs, 3)) == [("/a", 2), ("/b", 2), ("/c", 2)]
    assert pairs(ops.top_ips(logs, 2)) == [("1.1.1.1", 3), ("2.2.2.2", 2)]
    assert pairs(ops.top_error_paths(logs, 1)) == [("/b", 2)]
    assert pairs(ops.peak_hours(logs, 2)) == [
        (datetime(2024, 1, 2, 23), "2024-01-02 23:00", 3),
        (datetime(2024, 1, 1, 10), "2024-01-01 10:00", 2),
    ]


def test_shares(logs, empty):
    assert [(m, n, round(s, 2)) for m, n, s in pairs(ops.method_share(logs))] == [
        ("GET", 6, 85.71), ("POST", 1, 14.29)
    ]
    assert sum(r.share for r in ops.status_share(logs, 2).collect()) == 100.0
    assert pairs(ops.method_share(empty)) == []


def test_top_k_keeps_k_rows_per_task(logs):
    assert "TakeOrderedAndProject" in plan_of(ops.top_paths(logs))
    assert "TakeOrderedAndProject" in plan_of(ops.latest_errors(logs, 10, MARK))


def test_sort(logs):
    by_status = [r.line_no for r in ops.sort_logs(logs, "status_code").collect()]
    assert by_status == [1, 5, 4, 7, 8, 2, 6, 3]
    assert [r.line_no for r in ops.sort_logs(logs, "status_code", False).collect()][-1] == 3


def test_entry_numbers_follow_the_filter(lines, monkeypatch):
    monkeypatch.setattr("weblens.operators.sequence.CHUNK_LINES", 7)
    files = {f: [line("01/Jan/2024:10:00:00", status=200 + n) for n in range(50)] for f in "ab"}
    kept = parse_logs(lines(files), "apache").where("line_no % 3 = 0")
    rows = ops.status_sequence(kept).collect()
    for file in "ab":
        got = sorted((r.entry_number, r.status_code) for r in rows if r.file_path == file)
        assert got == [(i, 199 + 3 * i) for i in range(1, 17)]
    assert ops.project_series(kept).columns[0] == "entry_number"


def test_entry_numbers_of_a_plain_scan(spark):
    rows = [("f", block, block * 10 + n, 200 + n) for block in (0, 100, 200) for n in range(3)]
    scan = spark.createDataFrame(
        rows, "file_path string, block_start bigint, row_id bigint, status_code int"
    )
    got = sorted((r.entry_number, r.status_code) for r in ops.status_sequence(scan).collect())
    assert got == [(i + 1, 200 + i % 3) for i in range(9)]


MARK = datetime(2024, 1, 2, 23, 54, 59)


def test_new_errors_are_later_than_the_mark(logs):
    assert numbers(ops.new_errors(logs, MARK)) == [6, 7]
    assert numbers(ops.new_errors(logs, None)) == []
    assert one(ops.next_high_water(logs)) == (datetime(2024, 1, 3),)
    assert one(ops.next_high_water(logs.where("ts IS NULL"))) == (None,)
    mark = ops.next_high_water(ops.filter_date_range(logs, end=date(2024, 1, 1)))
    assert numbers(ops.new_errors(logs, mark)) == [4, 6, 7]


def test_alerts(logs):
    rows = {r.line_no: r for r in ops.flag_new_errors(logs, MARK).collect()}
    assert {n: r.severity for n, r in rows.items()} == {
        1: "none", 2: "error", 3: "none", 4: "warning", 5: "none", 6: "new", 7: "new", 8: "none"
    }
    assert rows[7].alert.startswith("NEW CLIENT_ERROR [2024-01-03 00:00:00]: 2.2.2.2 - -")
    assert rows[3].alert == "UNPARSED [Unknown time]: noise"


def test_latest_errors_go_by_place_in_the_file(logs):
    assert [r.line_no for r in ops.latest_errors(logs, 3).collect()] == [4, 6, 7]
    assert [r.is_new for r in ops.latest_errors(logs, 3, MARK).collect()] == [False, True, True]


def test_error_delta(logs):
    assert one(ops.error_delta(logs, 1)) == (4, 1, 3)
    assert one(ops.error_delta(logs, 4)) == (4, 4, None)
    assert one(ops.error_delta(logs, ops.error_count(ops.filter_status(logs, [500])))) == (4, 1, 3)


def test_error_levels_are_a_parameter(logs):
    assert one(ops.error_count(logs, ["UNPARSED"])) == (1,)
    assert S.ERROR_LEVELS == ("ERROR", "SERVER_ERROR", "CLIENT_ERROR")


def test_dashboard(logs):
    got = dashboard(logs, search="2.2.2.2", high_water=MARK)
    assert got["kpi_summary"].first().total_requests == 7
    assert numbers(got["rows"]) == [2, 7]
    assert numbers(got["latest_errors"]) == [2, 7]
    assert numbers(got["new_errors"]) == [7]
    for frame in got.values():
        assert frame.columns
    dated = dashboard(logs, date(2024, 1, 2), statuses=[404])
    assert numbers(dated["rows"]) == [4, 7]


def test_entry_numbers_of_one_large_block(spark, monkeypatch):
    monkeypatch.setattr("weblens.operators.sequence.CHUNK_LINES", 10)
    scan = spark.range(95).selectExpr(
        "'a.gz' AS file_path", "0L AS block_start", "id + 7 AS row_id", "cast(id AS int) AS status_code"
    )
    got = ops.status_sequence(scan.repartition(3)).collect()
    assert sorted((r.entry_number, r.status_code) for r in got) == [(i + 1, i) for i in range(95)]
    assert ops.status_sequence(scan.limit(0)).count() == 0
