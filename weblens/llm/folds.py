"""Which labelled rows a classifier may learn from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HELD_OUT = 2  # of four parts, by the checksum of the id
# Longer texts are not sampled for learning (they are scored whole like all others).
MOST_CHARS = 50_000


def held_out(doc_id: str) -> Column:
    """Whether a row is kept from learning; a row without an id is not, but has no label."""
    part = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(part == HELD_OUT, F.lit(False))


def sample_ids(rows: DataFrame, doc_id: str, most: int) -> DataFrame:
    """At most `most` ids, the first by a hash, so that they do not depend on partitions."""
    ids = rows.where(F.col(doc_id).isNotNull() & ~held_out(doc_id)).select(doc_id).distinct()
    return ids.orderBy(F.xxhash64(doc_id), doc_id).limit(most)


def sampled(docs: DataFrame, ids: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`(doc_id, text)` of the rows with one of a bounded number of ids."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.where(F.col("text").isNotNull() & (F.char_length("text") <= MOST_CHARS))
    return rows.join(F.broadcast(ids.withColumnRenamed(doc_id, "doc_id")), "doc_id", "left_semi")
