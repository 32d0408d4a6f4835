"""The threshold algorithm against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weblens.llm.top_k import SortedLists, top_k


def brute(rows, k):
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in ok]
    out = []
    for i, q in whole:
        if i % 10 == 0:
            found = [(-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in whole if j != i]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block,group", [(1000, 1000), (37, 3)])
def test_against_all_products(spark, block, group):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(200)]
    rows += [(300 + i, rows[20][1]) for i in range(30)]  # ties
    rows += [rows[10], (10_000, [0.0] * 8), (10_001, [1.0, 2.0]), (None, [1.0] * 8)]
    rows += [(10_002, None), (10_003, [None] * 8), (10_004, [float("nan")] * 8), (10_006, [float("inf")] * 8)]
    rows += [(10_010, [0.5] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS x", "2 AS block")
    got = top_k(table, F.col("vec_id") % 10 == 0, block=block, group=group)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_fewer_rows_than_k_and_none(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in top_k(table, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 131072)]
    assert top_k(table.limit(0), F.col("vec_id") == 0).count() == 0


def test_large_components_are_exact():
    vectors = np.array([[1 << 40, 3], [1 << 40, 1], [-(1 << 40), 5]], dtype=np.int64)
    ids, scores = SortedLists(np.arange(3), vectors).top(np.array([1 << 20, 1]), 0, 2)
    assert list(ids) == [1, 2] and list(scores) == [(1 << 60) + 1, -(1 << 60) + 5]


def test_it_stops_before_the_end():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-20, 20, (5000, 4))
    vectors[:10] *= 10
    lists = SortedLists(np.arange(5000), vectors)
    ids, _ = lists.top(vectors[0], 0, 3)
    products = vectors @ vectors[0]
    assert set(ids) == set(np.argsort(-products, kind="stable")[1:4])
