"""Facet counts out of bitmaps, without a look at the rows.

Each entry of a table gets a number, and for each value of a facet the numbers of its entries
are kept as bitmaps of 32,768 entries, a folder per day. A filter by values is then the union
of their bitmaps, filters together are an intersection, and a count is a popcount. One bitmap is
4 KB at most, whatever the rows behind it; a value held by a third of all rows has many of them.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblens.shared import cut_lineage

FACETS = ("error_level", "status_code")
BUCKET = ["part", "bucket"]
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("facet", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField("part", T.StringType()),
        T.StructField("log_date", T.DateType()),
    ]
)


def build_facet_index(logs: DataFrame, path: str, part: str = "all") -> None:
    """Write the bitmaps of `logs` under `path`.

    A table that grows adds each batch as a `part` of its own; a part written again replaces
    itself. Entries are numbered in a written copy of the three columns, as rows that come out
    of a shuffle may change places when a task is run again.
    """
    rows = cut_lineage(logs.select(F.to_date("ts").alias("log_date"), *FACETS))
    # Numbered before the facets are taken apart, so that both get the number of their entry.
    numbered = rows.select("log_date", *FACETS, F.monotonically_increasing_id().alias("number"))
    values = [
        F.struct(F.lit(name).alias("facet"), F.col(name).cast("string").alias("value"))
        for name in FACETS
    ]
    entries = numbered.select(
        "log_date",
        F.bitmap_bucket_number("number").alias("bucket"),
        F.bitmap_bit_position("number").alias("position"),
        F.inline(F.array(*values)),
    )
    bitmaps = entries.groupBy("log_date", "facet", "value", "bucket").agg(
        F.bitmap_construct_agg("position").alias("bits")
    )
    ordered = bitmaps.hint("rebalance", "log_date").sortWithinPartitions("log_date", "facet", "value")
    ordered.write.mode("overwrite").partitionBy("log_date").parquet(f"{path}/part={part}")


def read_facet_index(
    spark: SparkSession, path: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Bitmaps of the days between two bounds, both included; other days are not listed.

    A bound leaves out entries without a clock, as the date filter does.
    """
    index = spark.read.schema(INDEX_SCHEMA).parquet(path)
    if start is not None:
        index = index.where(F.col("log_date") >= F.lit(start))
    if end is not None:
        index = index.where(F.col("log_date") <= F.lit(end))
    return index


def _among(values: Iterable) -> Column:
    wanted = list(values)
    keep = F.col("value").isin([str(v) for v in wanted if v is not None])
    return keep | F.col("value").isNull() if None in wanted else keep


def _chosen(index: DataFrame, facet: str, values: Iterable) -> DataFrame:
    """One bitmap a bucket: the entries that hold one of the values."""
    rows = index.where((F.col("facet") == facet) & _among(values))
    return rows.groupBy(*BUCKET).agg(F.bitmap_or_agg("bits").alias("chosen"))


def facet_counts(
    index: DataFrame,
    levels: Iterable[str] | None = None,
    statuses: Iterable[int | None] | None = None,
) -> DataFrame:
    """`(facet, value, n)`: entries of each level and status under the filters.

    A facet's own filter does not count for it, so its other values stay on offer. Values
    without entries are left out. `index` is what `read_facet_index` gave for the days wanted.
    """
    filters = dict(zip(FACETS, (levels, statuses), strict=True))
    counts = []
    for facet in FACETS:
        rows = index.where(F.col("facet") == facet)
        for other, values in filters.items():
            if other == facet or values is None:
                continue
            # Both bitmaps of a bucket are in one place after the join; the group stays there.
            both = rows.join(_chosen(index, other, values), BUCKET)
            pair = F.explode(F.array("bits", "chosen")).alias("bits")
            pairs = both.select("facet", "value", "log_date", *BUCKET, pair)
            keys = ["facet", "value", "log_date", *BUCKET]
            rows = pairs.groupBy(*keys).agg(F.bitmap_and_agg("bits").alias("bits"))
        counted = rows.groupBy("facet", "value").agg(F.sum(F.bitmap_count("bits")).alias("n"))
        counts.append(counted.where("n > 0"))
    return counts[0].unionByName(counts[1])


def selected_count(
    index: DataFrame,
    levels: Iterable[str] | None = None,
    statuses: Iterable[int | None] | None = None,
) -> DataFrame:
    """`(n)`: entries that all filters keep."""
    chosen = [
        _chosen(index, facet, values)
        for facet, values in zip(FACETS, (levels, statuses), strict=True)
        if values is not None
    ]
    if not chosen:  # each entry has one level, be it NULL
        everything = index.where(F.col("facet") == FACETS[0]).select(F.col("bits").alias("chosen"))
        return everything.agg(F.coalesce(F.sum(F.bitmap_count("chosen")), F.lit(0)).alias("n"))
    stacked = chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])
    held = stacked.groupBy(*BUCKET).agg(
        F.bitmap_and_agg("chosen").alias("chosen"), F.count("*").alias("filters")
    )
    kept = held.where(F.col("filters") == len(chosen))
    return kept.agg(F.coalesce(F.sum(F.bitmap_count("chosen")), F.lit(0)).alias("n"))
