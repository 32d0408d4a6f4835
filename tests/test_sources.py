"""Scans: order, numbering and detection must not depend on how files are split."""

import gzip

import pytest

from tests.compare import plan_of
from weblens import schema as S
from weblens.operators import latest_errors
from weblens.plans import detect_format, parse_logs, read_logs, text_bounds
from weblens.shared import broadcast_within_limit, cut_lineage
from weblens.sources import (
    index_bounds,
    line_index,
    log_file_inventory,
    log_profile,
    number_lines,
    scan_log_text,
    table_key_lookup,
    table_scan_filter,
)

ACCESS = '10.0.0.{n} - - [23/Nov/2025:08:15:23 +0000] "GET /{n} HTTP/1.1" 200 {n}'


@pytest.fixture
def small_splits(spark):
    """Split files into blocks of a few lines."""
    keys = {
        "spark.sql.files.maxPartitionBytes": "300",
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.files.minPartitionNum": "1",
    }
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


def write(folder, files):
    for name, data in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(folder)


def by_name(rows, *columns):
    return {tuple([r.file_path.rsplit("/", 1)[-1], *[r[c] for c in columns[:-1]]]): r[columns[-1]] for r in rows}


FILES = {
    "a.log": "\n".join(ACCESS.format(n=n) for n in range(1, 101)) + "\n",
    "b.txt": "\n \n" + "\n".join(f"[x] [error] {n}" for n in range(60)) + "\n\n",
    "deep/c.log": "\n".join(f"line {n}" for n in range(30)),
    "access.log.1": "rotated\nlines\n",
    "access": "no ending",
    "empty.log": "",
    "blank.log": "\n\n  \n",
}


def expected_lines():
    got = {}
    for name, text in FILES.items():
        if text:
            rows = text.removesuffix("\n").split("\n")
            got |= {(name.rsplit("/", 1)[-1], n): row for n, row in enumerate(rows, 1)}
    return got


def test_numbering_over_many_blocks(spark, tmp_path, small_splits):
    scan = scan_log_text(spark, write(tmp_path, FILES))
    assert scan.select("file_path", "block_start").distinct().count() > 20
    assert by_name(number_lines(scan).collect(), "line_no", "raw") == expected_lines()


def test_numbering_of_whole_files(spark, tmp_path):
    scan = scan_log_text(spark, write(tmp_path, FILES))
    assert by_name(number_lines(scan).collect(), "line_no", "raw") == expected_lines()


def test_scan_order_is_file_order(spark, tmp_path, small_splits):
    scan = scan_log_text(spark, write(tmp_path, FILES))
    rows = scan.where("file_path LIKE '%a.log'").orderBy(*S.file_order(scan)).collect()
    assert [r.raw for r in rows] == [ACCESS.format(n=n) for n in range(1, 101)]


def test_bounds_of_index_and_of_lines_agree(spark, tmp_path, small_splits):
    scan = scan_log_text(spark, write(tmp_path, FILES))
    index = line_index(scan)
    from_index = {tuple(r) for r in index_bounds(index).collect()}
    assert from_index == {tuple(r) for r in text_bounds(number_lines(scan, index)).collect()}
    ends = {p.rsplit("/", 1)[-1]: (lo, hi) for p, lo, hi in from_index}
    assert ends == {
        "a.log": (1, 100), "b.txt": (3, 62), "c.log": (1, 30), "access.log.1": (1, 2), "access": (1, 1)
    }


def test_another_split_fails_instead_of_misnumbering(spark, tmp_path, small_splits):
    path = write(tmp_path, FILES)
    index = line_index(scan_log_text(spark, path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    with pytest.raises(Exception, match="split differently"):
        number_lines(scan_log_text(spark, path), index).collect()


def test_numbering_without_broadcast(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr("weblens.sources.text.broadcast_within_limit", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scan = scan_log_text(spark, write(tmp_path, FILES))
        numbered = number_lines(scan)
        assert by_name(numbered.collect(), "line_no", "raw") == expected_lines()
        plan = plan_of(numbered)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bytes_and_line_ends(spark, tmp_path):
    path = write(tmp_path, {"x.log": b"caf\xc3\xa9 \xff\xfe!\r\nkept \xef\xbf\xbd\nlast"})
    rows = scan_log_text(spark, path).orderBy("row_id").collect()
    assert [r.raw for r in rows] == ["café !\r", "kept �", "last"]


def test_read_logs_detects_each_file(spark, tmp_path, small_splits):
    logs = read_logs(spark, write(tmp_path, FILES))
    got = {
        (r.file_path.rsplit("/", 1)[-1], r.format, r.parse_status): r["count"]
        for r in logs.groupBy("file_path", "format", "parse_status").count().collect()
    }
    assert got == {
        ("a.log", "apache", "matched"): 100,
        ("b.txt", "error", "matched"): 60,
        ("c.log", "generic", "matched"): 30,
        ("access.log.1", "generic", "matched"): 2,
        ("access", "generic", "matched"): 1,
    }


def test_input_of_few_splits_is_spread(spark, tmp_path):
    logs = read_logs(spark, write(tmp_path, {"a.log": FILES["a.log"]}), "apache")
    assert "Exchange" in plan_of(logs)
    rows = logs.orderBy(*S.file_order(logs)).collect()
    assert [r.raw for r in rows] == [ACCESS.format(n=n) for n in range(1, 101)]


def test_read_logs_of_one_format_is_one_narrow_pass(spark, tmp_path, small_splits):
    logs = read_logs(spark, write(tmp_path, FILES), "apache")
    plan = plan_of(logs)
    assert "Exchange" not in plan and "Join" not in plan
    assert logs.where("parse_status = 'matched'").count() == 100
    numbered = read_logs(spark, str(tmp_path), "apache", numbered=True)
    assert numbered.where("status_code = 200 AND line_no = size_bytes").count() == 100


def test_outer_blanks_of_a_file_are_cut(spark, tmp_path):
    text = "\n\n   " + ACCESS.format(n=1) + "\n  " + ACCESS.format(n=2) + "\n" + ACCESS.format(n=3) + " \r\n"
    logs = read_logs(spark, write(tmp_path, {"x.log": text}))
    rows = logs.orderBy("line_no").collect()
    assert [(r.line_no, r.parse_status) for r in rows] == [
        (3, "matched"), (4, "fallback"), (5, "matched")
    ]
    assert rows[0].raw == ACCESS.format(n=1) and rows[2].raw == ACCESS.format(n=3)


NGINX = ACCESS.format(n=1)
ERROR = "[a] [b] c"


@pytest.mark.parametrize(
    ("texts", "format"),
    [
        ([NGINX], "apache"),  # every nginx line is an access line too
        ([NGINX] * 5 + ["x"] * 5, "apache"),
        ([NGINX] * 4 + ["x"] * 5, "generic"),
        ([ERROR] * 5 + ["x"] * 5 + [NGINX] * 90, "error"),
        ([ERROR] * 4 + ["x"] * 6 + [ERROR] * 90, "generic"),
        ([ERROR, "", ERROR], "error"),  # a blank inside counts as a miss
        ([ERROR, "", "", ERROR, ""], "error"),
        ([ERROR, "", "", "", ERROR], "generic"),
        (["", " ", "  " + NGINX, "x"], "apache"),
        (["free text"], "generic"),
    ],
)
def test_detection(lines, texts, format):
    assert [r.format for r in detect_format(lines(texts)).collect()] == [format]


def test_detection_of_many_files_and_blank_ones(lines):
    files = {"e": [ERROR], "g": ["x", "y"], "a": [NGINX], "blank": ["", " "]}
    got = {r.file_path: r.format for r in detect_format(lines(files)).collect()}
    assert got == {"e": "error", "g": "generic", "a": "apache"}


def test_profile(spark, tmp_path, small_splits):
    scan = scan_log_text(spark, write(tmp_path, FILES))
    rows = {r.file_path.rsplit("/", 1)[-1]: r for r in log_profile(number_lines(scan)).collect()}
    a = rows["a.log"]
    assert (a.total_lines, a.size_chars) == (100, len(FILES["a.log"]))
    assert a["sample"].split("\n") == FILES["a.log"].split("\n")[:10]


def test_inventory(spark, tmp_path):
    rows = log_file_inventory(spark, write(tmp_path, FILES)).collect()
    assert {(r.name, r.size, r.type) for r in rows} == {
        (n.rsplit("/", 1)[-1], len(t), "file") for n, t in FILES.items() if t
    }
    assert all(r.modified is not None and r.path.endswith(r.name) for r in rows)


def test_inventory_reads_no_content(spark, tmp_path):
    assert "content" not in plan_of(log_file_inventory(spark, write(tmp_path, FILES)))


def test_lookup_by_list_and_by_frame(spark):
    table = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "k int, v string")
    keys = spark.createDataFrame([(1,), (1,), (3,), (None,)], "other int")
    assert sorted(r.v for r in table_key_lookup(table, "k", keys).collect()) == ["a", "b", "d"]
    assert [tuple(r) for r in table_key_lookup(table, "k", [2], ["v"]).collect()] == [("c",)]


def test_scan_filter(spark):
    table = spark.range(10)
    assert table_scan_filter(table).count() == 10
    assert table_scan_filter(table, "id >= 7").count() == 3


def test_broadcast_only_within_the_limit(spark):
    small = cut_lineage(spark.range(100).selectExpr("id", "repeat('x', 50) AS s"))
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(broadcast_within_limit(small))
    assert "broadcast" not in plan(broadcast_within_limit(small, limit_bytes=5_000))


NESTED = {
    "array(repeat('x', 50), repeat('y', 50))": 100 * 100,
    "struct(1 AS `a.b`, repeat('x', 90) AS s)": 100 * 90,
    "map(repeat('k', 50), array(repeat('v', 50)))": 100 * 100,
    "CAST(repeat('x', 90) AS binary)": 100 * 90,
    "array(struct(array(1, 2), NULL AS n), NULL)": 100 * 16 * 4,
    "CAST(NULL AS array<string>)": 0,
}


@pytest.mark.parametrize("value", NESTED)
def test_broadcast_measures_nested_values(spark, value):
    table = cut_lineage(spark.range(100).selectExpr(f"{value} AS `a b`"))
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    least = NESTED[value]
    assert "broadcast" not in plan(broadcast_within_limit(table, limit_bytes=max(least, 100 * 47)))
    assert "broadcast" in plan(broadcast_within_limit(table, limit_bytes=3 * least + 100 * 100))


def test_latest_errors_do_not_depend_on_the_split(spark, tmp_path, small_splits):
    text = {"a.log": "\n".join(ACCESS.format(n=n).replace(" 200 ", " 500 ") for n in range(100))}
    scan = scan_log_text(spark, write(tmp_path, text))
    by_scan = latest_errors(parse_logs(scan, "apache"), 7).collect()
    by_line = latest_errors(parse_logs(number_lines(scan), "apache"), 7).collect()
    assert [r.raw for r in by_scan] == [r.raw for r in by_line]
    assert [r.path for r in by_scan] == [f"/{n}" for n in range(93, 100)]


def test_any_file_a_path_names_is_read(spark, tmp_path):
    text = "".join(ACCESS.format(n=n) + "\n" for n in range(5))
    names = ["access", "access.log.1", "access.log.2024-01-01", "access.csv"]
    path = write(tmp_path, {n: text for n in names} | {"access.log.gz": gzip.compress(text.encode())})
    assert read_logs(spark, path, "apache").count() == 25
    for name in ("access.log.1", "access.log.gz"):
        assert read_logs(spark, f"{path}/{name}", "apache").where("status_code = 200").count() == 5
    assert read_logs(spark, path, "apache", glob="*.csv").count() == 5


def test_numbering_survives_another_number_of_cores(spark, tmp_path):
    path = write(tmp_path, {"big.log": "\n".join(f"line {n:060d}" for n in range(150_000))})
    index = line_index(scan_log_text(spark, path))
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "64")
    try:
        numbered = number_lines(scan_log_text(spark, path), index)
        assert numbered.where("raw <> concat('line ', lpad(line_no - 1, 60, '0'))").isEmpty()
        assert numbered.count() == 150_000
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
