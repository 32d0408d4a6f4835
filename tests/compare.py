"""Compare a Spark result with DuckDB's, as sorted rows of plain values."""

from __future__ import annotations

import contextlib
import io
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return value if not math.isinf(value) else str(value)
    return str(value)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in data]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows(df.columns, df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    return sorted(names), rows(names, got.fetchall())


def plan_of(df) -> str:
    """The physical plan with the details of its scans."""
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain("formatted")
    return text.getvalue()
