"""Line by line: what each format makes of well-formed and broken lines."""

from datetime import datetime

import pytest

from weblens.plans import parse_access_strict, parse_logs, parse_summary

GOOD = '192.168.1.100 - - [23/Nov/2025:08:15:23 +0000] "GET /index.html HTTP/1.1" 200 1234'
NOON = datetime(2025, 11, 23, 8, 15, 23)


def parsed(lines, raw, format, *columns):
    (row,) = parse_logs(lines([raw]), format).select(*columns).collect()
    return tuple(row)


def access(lines, raw):
    return parsed(
        lines, raw, "apache",
        "parse_status", "ip", "timestamp_raw", "method", "path", "protocol", "status_raw",
        "size_raw", "error_level",
    )


def test_access_line(lines):
    assert access(lines, GOOD) == (
        "matched", "192.168.1.100", "23/Nov/2025:08:15:23 +0000", "GET", "/index.html",
        "HTTP/1.1", "200", "1234", "SUCCESS",
    )


def test_combined_access_line_keeps_what_follows_in_raw(lines):
    raw = GOOD + ' "http://example.test/" "Agent/1.0"'
    assert parsed(lines, raw, "apache", "parse_status", "size_bytes", "raw") == (
        "matched", 1234, raw
    )


@pytest.mark.parametrize(
    ("status", "level"),
    [
        ("199", "SUCCESS"), ("200", "SUCCESS"), ("299", "SUCCESS"), ("300", "REDIRECT"),
        ("399", "REDIRECT"), ("400", "CLIENT_ERROR"), ("499", "CLIENT_ERROR"),
        ("500", "SERVER_ERROR"), ("99999999999", "SERVER_ERROR"),
    ],
)
def test_status_levels(lines, status, level):
    got = parsed(lines, GOOD.replace(" 200 ", f" {status} "), "apache", "status_code", "error_level")
    assert got == (int(status) if len(status) < 10 else None, level)


def test_size_dash(lines):
    raw = GOOD.replace("1234", "-")
    assert parsed(lines, raw, "apache", "size_raw", "size_bytes") == ("-", None)
    assert parse_access_strict(lines([raw])).first()["size"] == 0


@pytest.mark.parametrize(
    ("bracket", "clock", "instant"),
    [
        ("23/Nov/2025:08:15:23 +0000", NOON, NOON),
        ("23/Nov/2025:08:15:23 +0200", NOON, datetime(2025, 11, 23, 6, 15, 23)),
        ("23/Nov/2025:08:15:23 -05:30", NOON, datetime(2025, 11, 23, 13, 45, 23)),
        ("23/nov/2025:8:15:23 Z", NOON, NOON),
        ("23/Nov/2025:08:15:23", NOON, None),
        ("23/Nov/2025:08:15:23 junk", NOON, None),
        (" 23/Nov/2025:08:15:23 +0000", NOON, NOON),
        ("3/Nov/2025:08:15:23 +0000", datetime(2025, 11, 3, 8, 15, 23), None),
        ("23/Nov/2025:08:15:23+0000", None, None),
        ("31/Feb/2025:08:15:23 +0000", None, None),
        ("23/Foo/2025:08:15:23 +0000", None, None),
        ("23/Nov/2025:25:15:23 +0000", None, None),
        ("2025-11-23 08:15:23", None, None),
        ("", None, None),
        ("-", None, None),
    ],
)
def test_access_clocks(lines, bracket, clock, instant):
    raw = f'1.2.3.4 - - [{bracket}] "GET / HTTP/1.1" 200 5'
    assert parsed(lines, raw, "apache", "parse_status", "timestamp_raw", "ts") == (
        "matched", bracket, clock
    )
    if instant:
        utc = parse_logs(lines([raw]), "apache").selectExpr("cast(ts_utc AS string) AS u")
        assert utc.first().u == str(instant)


CLOCK = "23/Nov/2025:08:15:23"


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        # no protocol
        (
            f'1.2.3.4 - - [{CLOCK} +0000] "GET /x" 408 -',
            ("1.2.3.4", f"{CLOCK} +0000", "GET", "/x", "-", "408", "-"),
        ),
        # empty request
        (
            f'1.2.3.4 - - [{CLOCK} +0000] "" 400 0',
            ("1.2.3.4", f"{CLOCK} +0000", "-", "-", "-", "400", "0"),
        ),
        # one quote only: no request, the rest after it is status and size
        (
            f'1.2.3.4 - - [{CLOCK} +0000] "GET /x',
            ("1.2.3.4", f"{CLOCK} +0000", "-", "-", "-", "GET", "/x"),
        ),
        # no quotes: the last two tokens
        ("a b c d e", ("a", "-", "-", "-", "-", "d", "e")),
        ("a b c  d  ", ("a", "-", "-", "-", "-", "d", "")),
        # a leading blank makes an empty first token
        (" a b c d", ("", "-", "-", "-", "-", "c", "d")),
        # words of the request beyond three are dropped; text after the last quote counts
        (
            '9.9.9.9 x "GET  /a b HTTP/1.0 more" 200 17 "ref" "agent"',
            ("9.9.9.9", "-", "GET", "/a", "b", "-", "-"),
        ),
        ('9.9.9.9 x "GET /a" 200', ("9.9.9.9", "-", "GET", "/a", "-", "200", "-")),
        # brackets after the quotes, and empty ones
        ('a "b c d e f" 1 2 [late]', ("a", "late", "b", "c", "d", "1", "2")),
        ("a b c d []", ("a", "", "-", "-", "-", "d", "[]")),
        ('"a b" c "d" e f', ("", "-", "a", "b", "-", "e", "f")),
    ],
)
def test_malformed_access_lines(lines, raw, expected):
    got = access(lines, raw)
    assert got == ("fallback", *expected, "INFO")


@pytest.mark.parametrize(
    ("bracket", "clock"),
    [
        (f"{CLOCK} +0000", NOON),
        (f"{CLOCK} junk", NOON),
        (f"{CLOCK}\t+0000", NOON),
        (CLOCK, None),  # standing alone it does not count here
        (f"{CLOCK}\tjunk", None),
        ("31/Feb/2025:08:15:23 +0000", None),
    ],
)
def test_malformed_access_clocks(lines, bracket, clock):
    raw = f'1.2.3.4 - - [{bracket}] "GET /x" 408 -'
    assert parsed(lines, raw, "apache", "parse_status", "ts") == ("fallback", clock)


def test_fallback_status_is_typed_but_not_classified(lines):
    raw = f'1.2.3.4 - - [{CLOCK} +0000] "GET /x" 503 12'
    got = parsed(lines, raw, "apache", "status_code", "size_bytes", "error_level")
    assert got == (503, 12, "INFO")


@pytest.mark.parametrize("raw", ["a b c d", "noise", '"', "a b c"])
def test_too_few_tokens_are_unparsed(lines, raw):
    got = parsed(lines, raw, "apache", "parse_status", "error_level", "raw", "ip", "status_raw")
    assert got == ("unparsed", "UNPARSED", raw, None, None)


def test_five_tokens_by_quotes(lines):
    assert access(lines, '""""')[0] == "fallback"
    assert access(lines, 'a "" b')[0] == "unparsed"


def test_long_broken_lines_finish(lines):
    long = ["x" * 200_000, 'x "' + "y " * 100_000, "[" * 200_000 + " a b c d", '"' * 50_001]
    assert parse_logs(lines(long), "apache").count() == 4
    assert parse_logs(lines(long), "generic").where("ts IS NULL").count() == 4
    assert parse_logs(lines(long), "error").where("parse_status = 'unparsed'").count() == 4


def test_nginx_line(lines):
    row = parse_logs(lines([GOOD]), "nginx").first()
    assert (row.parse_status, row.ip, row.status_code, row.size_bytes) == (
        "matched", "192.168.1.100", 200, 1234
    )
    assert (row.ts, row.timestamp_raw, row.error_level) == (NOON, None, "SUCCESS")


@pytest.mark.parametrize("raw", [GOOD.replace("1234", "-"), GOOD.replace("- -", "- bob")])
def test_nginx_is_stricter(lines, raw):
    assert parsed(lines, raw, "nginx", "parse_status", "error_level") == ("unparsed", "UNPARSED")


@pytest.mark.parametrize(
    ("level", "upper", "status"),
    [
        ("error", "ERROR", 500), ("core:error", "CORE:ERROR", 500), ("CRIT", "CRIT", 500),
        ("warn", "WARN", 400), ("notice", "NOTICE", 200), ("", "", 200),
    ],
)
def test_error_levels(lines, level, upper, status):
    raw = f"[Sun Nov 23 08:15:23 2025] [{level}] it broke"
    got = parsed(lines, raw, "error", "ts", "error_level", "status_code", "message")
    assert got == (NOON, upper, status, "it broke")


@pytest.mark.parametrize(
    ("clock", "ts"),
    [
        (CLOCK, NOON),
        ("Mon Nov 23 08:15:23 2025", NOON),  # a wrong weekday's name does not matter
        ("sun  nov 23  08:15:23 2025", NOON),
        ("Sun Nov 3 8:15:23 2025", datetime(2025, 11, 3, 8, 15, 23)),
        ("Xyz Nov 23 08:15:23 2025", None),
        ("Sun Nov 23 08:15:23.123456 2025", None),
        ("Sun Nov 31 08:15:23 2025", None),
        ("2025-11-23 08:15:23", None),
    ],
)
def test_error_clocks(lines, clock, ts):
    raw = f"[{clock}] [error] x"
    assert parsed(lines, raw, "error", "parse_status", "ts") == ("matched", ts)


def test_carriage_return_is_part_of_the_line(lines):
    raw = "[Sun Nov 23 08:15:23 2025] [error] one\rtwo\r"
    assert parsed(lines, raw, "error", "message") == ("one\rtwo\r",)


@pytest.mark.parametrize(
    ("raw", "ts", "level"),
    [
        ("2025-11-23 08:15:23 all fine", NOON, "INFO"),
        ("x 2025-11-23   08:15:23 terror", NOON, "ERROR"),
        ("2025-11-23\t08:15:23 forewarned", NOON, "WARNING"),
        ("at 23/Nov/2025:08:15:23 critical", NOON, "ERROR"),
        ("[23/Nov/2025:08:15:23 +0100] Fatal", NOON, "ERROR"),
        ("[23/Nov/2025:08:15:23] then 2024-01-01 00:00:00", datetime(2024, 1, 1), "INFO"),
        ("2025-13-45 08:15:23 [2025-11-23]", None, "INFO"),  # the first form decides
        ("[INFO] 8:15", None, "INFO"),
        ("[2025-11-23]", datetime(2025, 11, 23), "INFO"),
        ("[2025-11-23T08:15:23Z] up", NOON, "INFO"),
        ("[2025-11-23T08:15:23.250+02:00]", datetime(2025, 11, 23, 8, 15, 23, 250000), "INFO"),
        ("[Sun Nov 23 08:15:23.500000 2025] x", datetime(2025, 11, 23, 8, 15, 23, 500000), "INFO"),
        ("[Sun, 23 Nov 2025 08:15:23 GMT]", NOON, "INFO"),
        ("[Nov 23, 2025 08:15:23]", NOON, "INFO"),
        ("[11/23/2025 08:15:23]", NOON, "INFO"),
        ("[2025/11/23 08:15:23]", NOON, "INFO"),
        ("[2025-11-23T08:15:23,123]", datetime(2025, 11, 23, 8, 15, 23, 123000), "INFO"),
        ("[2025-11-23 08:15:23,5] x", NOON, "INFO"),  # the plain form decides
        ("[11/23/2025 08:15]", datetime(2025, 11, 23, 8, 15), "INFO"),
        ("[23/11/2025 08:15:23]", NOON, "INFO"),
        ("[5/6/2025]", datetime(2025, 5, 6), "INFO"),
        ("[13/13/2025]", None, "INFO"),
        ("[2025/11/23]", datetime(2025, 11, 23), "INFO"),
        ("[11/23/2025 08:15:23 AM] x", NOON, "INFO"),
        ("[11/23/2025 08:15:23 PM]", datetime(2025, 11, 23, 20, 15, 23), "INFO"),
        ("[11/23/2025 8:15 pm]", datetime(2025, 11, 23, 20, 15), "INFO"),
        ("[Nov 23, 2025 12:00:01AM]", datetime(2025, 11, 23, 0, 0, 1), "INFO"),
        ("[2025/11/23 12:30:00 PM]", datetime(2025, 11, 23, 12, 30), "INFO"),
        ("[2025/11/23 1:30:00.5 PM +0100]", datetime(2025, 11, 23, 13, 30, 0, 500000), "INFO"),
        ("[11/23/2025 13:15:23 PM]", None, "INFO"),  # no hour of a half day
        ("[11/23/2025 PM]", None, "INFO"),
        ("[20251123 081523]", NOON, "INFO"),
        ("[20251123T081523Z] up", NOON, "INFO"),
        ("[20251123081523]", NOON, "INFO"),
        ("[20251123]", datetime(2025, 11, 23), "INFO"),
        ("[20251323 081523]", None, "INFO"),
        ("[20251123 0815]", None, "INFO"),
        ("[Nov 23, 2025]", datetime(2025, 11, 23), "INFO"),
        ("[23 Nov 2025 08:15]", datetime(2025, 11, 23, 8, 15), "INFO"),
        ("[pid 7] [2025-11-23]", None, "INFO"),  # only the first bracket is looked at
        ("no clock, WARNing", None, "WARNING"),
    ],
)
def test_generic_lines(lines, raw, ts, level):
    got = parsed(lines, raw, "generic", "parse_status", "ts", "error_level", "message")
    assert got == ("matched", ts, level, raw)


def test_generic_instants(lines):
    raw = ["[2025-11-23T08:15:23+02:00]", "2025-11-23 08:15:23"]
    logs = parse_logs(lines(raw), "generic").selectExpr("line_no", "cast(ts_utc AS string) AS u")
    assert dict(logs.collect()) == {1: "2025-11-23 06:15:23", 2: None}


def test_clocks_do_not_depend_on_the_session_zone(spark, lines):
    raw = [GOOD.replace("23/Nov/2025:08", "09/Mar/2025:02")]  # skipped hour in New York
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = parse_logs(lines(raw), "apache").selectExpr("cast(ts AS string) AS t").first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == "2025-03-09 02:15:23"


def test_strict_lines(lines):
    rows = [GOOD, GOOD.replace("1234", "abc"), GOOD.replace("[23/Nov/2025:08:15:23 +0000]", "[]"), ""]
    got = parse_access_strict(lines(rows)).collect()
    assert [tuple(r) for r in got] == [
        (
            "a.log", 1, "192.168.1.100", "23/Nov/2025:08:15:23 +0000", "GET", "/index.html",
            200, 1234,
        )
    ]


def test_summary_counts_from_first_to_last_text(lines):
    files = {"a": ["", " ", GOOD, "", "x", GOOD, " ", ""], "blank": ["", ""], "one": [GOOD]}
    got = {r.file_path: (r.total_lines, r.parsed_count) for r in parse_summary(lines(files)).collect()}
    assert got == {"a": (4, 2), "blank": (1, 0), "one": (1, 1)}
    capped = {r.file_path: r.parsed_count for r in parse_summary(lines(files), cap=3).collect()}
    assert capped == {"a": 1, "blank": 0, "one": 1}
