"""Facets counted out of bitmaps against counts of the rows."""

import random
from datetime import date, datetime
from itertools import product

import pytest

from weblens import operators as ops

LEVELS = ["SUCCESS", "SERVER_ERROR", "INFO", None]
STATUSES = [200, 404, 500, None]
DAYS = [datetime(2024, 1, d, 12) for d in (1, 2, 3)] + [None]
SHAPE = "ts timestamp_ntz, error_level string, status_code int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [(rng.choice(DAYS), rng.choice(LEVELS), rng.choice(STATUSES)) for _ in range(70_000)]


@pytest.fixture(scope="module")
def indexed(spark, rows, tmp_path_factory):
    """Two parts, one of them written twice."""
    path = str(tmp_path_factory.mktemp("facets"))
    logs = spark.createDataFrame(rows, SHAPE)
    ops.build_facet_index(logs.limit(10), path, part="b")
    ops.build_facet_index(spark.createDataFrame(rows[:40_000], SHAPE).coalesce(1), path, part="a")
    ops.build_facet_index(spark.createDataFrame(rows[40_000:], SHAPE), path, part="b")
    return path


def counts(rows, start, end, levels, statuses):
    kept = [
        r for r in rows
        if (start is None or (r[0] and r[0].date() >= start)) and (end is None or (r[0] and r[0].date() <= end))
    ]
    found = {}
    for _, level, status in kept:
        if statuses is None or status in statuses:
            found["error_level", level] = found.get(("error_level", level), 0) + 1
        if levels is None or level in levels:
            value = None if status is None else str(status)
            found["status_code", value] = found.get(("status_code", value), 0) + 1
    n = sum((levels is None or x in levels) and (statuses is None or y in statuses) for _, x, y in kept)
    return found, n


SPANS = [(None, None), (date(2024, 1, 2), None), (date(2024, 1, 1), date(2024, 1, 2)), (date(2030, 1, 1), None)]
WANTED = [(None, None), (["INFO"], None), (["SUCCESS", "INFO"], [200, None]), ([], [404])]


@pytest.mark.parametrize("span,wanted", list(product(SPANS, WANTED)))
def test_counts_are_those_of_the_rows(spark, rows, indexed, span, wanted):
    index = ops.read_facet_index(spark, indexed, *span)
    found, n = counts(rows, *span, *wanted)
    assert {(r.facet, r.value): r.n for r in ops.facet_counts(index, *wanted).collect()} == found
    assert ops.selected_count(index, *wanted).first().n == n


def test_values_on_offer_are_those_of_the_scan(spark, rows, indexed):
    logs = spark.createDataFrame(rows, SHAPE)
    bounds = (date(2024, 1, 1), date(2024, 1, 2))
    index = ops.read_facet_index(spark, indexed, *bounds)
    got = {(r.facet, r.value) for r in ops.facet_counts(index, ["INFO", "SUCCESS"]).collect()}
    want = ops.facet_values(logs, *bounds, ["INFO", "SUCCESS"])
    assert got == {tuple(r) for r in want.collect()}


def test_no_rows(spark, tmp_path):
    ops.build_facet_index(spark.createDataFrame([], SHAPE), str(tmp_path))
    index = ops.read_facet_index(spark, str(tmp_path))
    assert ops.facet_counts(index, ["INFO"]).collect() == []
    assert ops.selected_count(index).first().n == 0
