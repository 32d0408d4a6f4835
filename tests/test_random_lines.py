"""Random lines, mostly broken: Spark's parsers against the same rules in SQL."""

import random

import pytest

from registry import oracle
from tests.compare import duck_rows, spark_rows
from weblens.plans import parse_logs

PIECES = [
    '"', '"', " ", " ", " ", "  ", "\t", "[", "]", "[]", "- -", "-", "1.2.3.4", "GET", "/x",
    "HTTP/1.1", '"GET /x HTTP/1.1"', '"GET /x"', '""', "200", "404", "99999999999", "3.", "+7",
    "[23/Nov/2025:08:15:23 +0000]", "[x] [error]", "é", "\r", ",",
]
WHOLE = [
    '1.2.3.4 - - [23/Nov/2025:08:15:23 +0000] "GET /x HTTP/1.1" 200 12',
    '1.2.3.4 - bob [23/Nov/2025:08:15:23 +0000] "GET /x HTTP/1.1" 404 - "r" "a"',
    "[Sun Nov 23 08:15:23 2025] [core:error] [pid 7] it broke",
]


def random_lines(seed, count=3000):
    pick = random.Random(seed)
    for _ in range(count):
        if pick.random() < 0.3:
            # a good line with a few characters changed
            text = list(pick.choice(WHOLE))
            for _ in range(pick.randrange(4)):
                at = pick.randrange(len(text))
                text[at : at + pick.randrange(3)] = pick.choice(PIECES)
            yield "".join(text)
        else:
            yield "".join(pick.choice(PIECES) for _ in range(pick.randrange(1, 16)))


@pytest.mark.parametrize(
    ("format", "in_sql"),
    [
        ("apache", oracle.access_rows),
        ("nginx", oracle.nginx_rows),
        ("error", oracle.error_rows),
        ("generic", oracle.generic_rows),
    ],
)
@pytest.mark.parametrize("seed", [1, 2])
def test_random_lines(spark, lines, tmp_path, format, in_sql, seed):
    import duckdb

    frame = lines(list(random_lines(seed)))
    frame.write.parquet(str(tmp_path / "lines"))
    # Clocks have tests of their own: the SQL reads only the usual ones.
    columns = [c for c in oracle.NAMES.replace(" ", "").split(",") if c != "ts"]
    in_duck = in_sql(f"SELECT * FROM '{tmp_path}/lines/*.parquet'")
    got = spark_rows(parse_logs(frame, format).select(columns))
    expected = duck_rows(duckdb.connect(), f"SELECT {', '.join(columns)} FROM ({in_duck})")
    assert got[0] == expected[0]
    assert [r for r in got[1] if r not in set(expected[1])][:5] == []
    assert got == expected
