"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from registry import lines as L
from registry.oracle import ORACLE, PROSE_LINES, error_rows, nginx_rows
from registry.queries import PARSED, QUERIES
from tests.compare import duck, duck_rows, spark_rows
from weblens.plans import parse_logs

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert spark_rows(queries()[name](spark, SF_DIR)) == duck_rows(con, oracle_sql()[name])


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("form,rows", [("nginx", nginx_rows), ("error", error_rows)])
def test_parsers_meet_prose_too(spark, con, form, rows):
    got = parse_logs(L.prose_lines(spark, SF_DIR), form).select(PARSED)
    assert spark_rows(got) == duck_rows(con, rows(PROSE_LINES))
