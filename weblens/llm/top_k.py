"""Exact top-k inner products by Fagin's threshold algorithm, in blocks.

Vectors are spread over blocks by a hash of their ids, so blocks are even whatever repeats. A
block keeps, for each dimension, its rows sorted by that component. A query reads the lists
of its dimensions in step, from the end where its products are largest, and works out the
whole score of each row it meets. No row it has not met can beat the sum of the products at the
places reached; once that bound is below the k-th best score the block is done. A query's best
rows of all blocks are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from weblens.llm.common import batch_of, share
from weblens.shared import cut_lineage

BLOCK = 16_384
QUERIES = 1024
FIRST_DEPTH, GROWTH = 32, 4

BEST = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class SortedLists:
    """One block: rows in order of their ids, and each dimension's rows by its component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        most = np.abs(vectors).max(initial=0)
        # Doubles are exact below 2**53; beyond that Python's integers are.
        exact = float(most) ** 2 * max(1, vectors.shape[1]) < 2.0**53
        self.kind = np.float64 if exact else object
        self.rows = vectors[order].astype(self.kind)
        self.lists = np.ascontiguousarray(np.argsort(vectors[order], axis=0, kind="stable").T)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the `k` best rows but `own`; ties go to smaller ids."""
        n = len(self.ids)
        query = query.astype(self.kind)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met = np.zeros(n, bool)
        best = np.zeros(0, np.int64)
        scores = np.zeros(0, self.kind)
        depth, until = 0, FIRST_DEPTH
        while True:
            until = min(until, n) if len(up) or len(down) else n
            new = np.zeros(n, bool)
            if until == n:
                new[:] = True
            else:
                new[self.lists[up, n - until : n - depth]] = True
                new[self.lists[down, depth:until]] = True
            new &= ~met
            met |= new
            found = np.flatnonzero(new)
            best = np.concatenate([best, found])
            scores = np.concatenate([scores, self.rows[found] @ query])
            other = self.ids[best] != own
            best, scores = best[other], scores[other]
            if len(best) > k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                keep = scores >= kth
                best, scores = best[keep], scores[keep]
                order = np.lexsort((best, -scores))[:k]
                best, scores = best[order], scores[order]
            if until == n:
                break
            if len(best) == k:
                bound = query[up] @ self.rows[self.lists[up, n - until], up]
                bound += query[down] @ self.rows[self.lists[down, until - 1], down]
                if bound < scores.min():
                    break
            depth, until = until, until * GROWTH
        order = np.lexsort((best, -scores))
        return self.ids[best[order]], scores[order]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    rows = column.to_pylist()
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """Components as `floor(scale * x)`."""
    return F.transform(vector, lambda x: F.floor(scale * x.cast("double")))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
    group: int = QUERIES,
) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: the `k` best rows for each row that `is_query` picks.

    The score is the inner product of the components as whole numbers; missing components of
    a shorter vector count as zero. A row is no candidate for a query of its own id. Ties go
    to the smaller id. Rows without an id, and vectors that are null or hold a null or a
    component that is not finite, take no part; rows repeated with one vector count once.
    """
    x_ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).alias("x"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    rows = rows.where(F.forall("x", lambda x: F.coalesce(x_ok(x.cast("double")), F.lit(False))))
    rows = rows.select("vec_id", "asks", whole_numbers(F.col("x")).alias("x"))
    rows = cut_lineage(rows.dropDuplicates(["vec_id", "x"]))
    size = rows.agg(
        F.count("*").alias("n"),
        F.sum(F.col("asks").cast("long")).alias("asks"),
        F.max(F.size("x")).alias("width"),
    ).first()
    blocks = max(1, math.ceil(size["n"] / block))
    groups = max(1, math.ceil((size["asks"] or 0) / group))
    width = size["width"] or 0
    share(vectors.sparkSession, None)

    def search(key, asking: pa.Table, held: pa.Table) -> pa.Table:
        found = []
        if asking.num_rows and held.num_rows:
            lists = SortedLists(held["vec_id"].to_numpy(), _matrix(held["x"], width))
            queries = _matrix(asking["x"], width)
            for own, query in zip(asking["vec_id"].to_pylist(), queries, strict=True):
                ids, scores = lists.top(query, own, k)
                found += [(own, int(i), int(s)) for i, s in zip(ids, scores, strict=True)]
        return pa.Table.from_batches([batch_of(found, BEST)])

    mixed = F.xxhash64("vec_id")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = rows.select(
        "vec_id",
        "x",
        F.pmod(mixed, F.lit(blocks)).cast("int").alias("block"),
        all_of(groups).alias("part"),
    )
    asking = rows.where("asks").select(
        F.col("vec_id"), F.col("x"), F.pmod(mixed, F.lit(groups)).cast("int").alias("part"),
        all_of(blocks).alias("block"),
    )
    pairs = asking.groupBy("block", "part").cogroup(held.groupBy("block", "part"))
    best = pairs.applyInArrow(search, from_arrow_schema(BEST))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.distinct().withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
