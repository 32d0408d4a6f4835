"""Drop lines that an earlier document has, with levelled sorted runs of line hashes.

Documents are taken in batches of ascending ids. A batch's line hashes are first reduced to
one row per hash with the smallest id that holds it, so a line found everywhere costs one row
per task. These rows are merge-anti-joined with the runs of earlier batches, which are
bucketed and sorted by hash and so are read without a shuffle; what is left is new and is
written as the batch's own run. A line stays if its hash is in that run with this very
document as its first; that join's key holds the document, so a frequent line is no hot key.

Runs are kept in levels. When a level has `fanout` runs, they are compacted into one run of
the next level, so a batch meets few runs however many came before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblens.llm.common import KEY, free_name, lower_ascii, row_key
from weblens.shared import cut_lineage, new_shared_path

BLANKS = " \t\n\x0b\x0c\r"
HASH = ["__h1", "__h2"]


class LineRuns:
    """Sorted runs of `(hash, first document)`, each hash in one run only."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark = spark
        self.fanout = fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, keys: DataFrame) -> DataFrame:
        """Keep the rows of `keys` whose hash is new as a run; that run is returned."""
        self._compact()
        for run in self.tables():
            keys = keys.join(run, HASH, "left_anti")
        name = self._write(keys)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(name)
        return self.spark.table(name)

    def _compact(self) -> None:
        for i in range(len(self.levels)):
            if len(self.levels[i]) >= self.fanout:
                merged = self.spark.table(self.levels[i][0])
                for name in self.levels[i][1:]:
                    merged = merged.unionByName(self.spark.table(name))
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(self._write(merged))
                self._forget(self.levels[i])
                self.levels[i] = []

    def _forget(self, names: list[str]) -> None:
        """Take tables out of the catalog; their files stay in the shared folder."""
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        for level in self.levels:
            self._forget(level)
        self.levels = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.repartition(self.buckets, *HASH)
            .write.bucketBy(self.buckets, *HASH)
            .sortBy(*HASH)
            .option("path", new_shared_path(self.spark, "line-run"))
            .saveAsTable(name)
        )
        return name


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """A row per line that can be dropped: its row's key, place, document and hash."""
    lowered = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    lines = docs.select(
        row_key(doc_id, text).alias(KEY),
        F.col(doc_id).alias("__doc"),
        F.posexplode(F.split(lowered, "\n", -1)).alias("__at", "__line"),
    )
    line = F.btrim("__line", F.lit(BLANKS))
    lines = lines.select(KEY, "__doc", "__at", line.alias("__line"))
    return lines.where(F.char_length("__line") >= min_chars).select(
        KEY,
        "__doc",
        "__at",
        F.xxhash64("__line").alias(HASH[0]),
        F.xxhash64(F.lit(7), F.col("__line")).alias(HASH[1]),
    )


def batches_by_id(docs: DataFrame, doc_id: str, count: int) -> list[DataFrame]:
    """`docs` in about equal parts of ascending ids; rows without an id are in the last."""
    at = F.percentile_approx(doc_id, [i / count for i in range(1, count)], 1000)
    cuts = sorted(set(docs.agg(at).first()[0] or [])) if count > 1 else []
    parts = []
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = docs
        if low is not None and high is not None:
            part = part.where((F.col(doc_id) > low) & (F.col(doc_id) <= high))
        elif low is not None:
            part = part.where((F.col(doc_id) > low) | F.col(doc_id).isNull())
        elif high is not None:
            part = part.where(F.col(doc_id) <= high)
        parts.append(part)
    return parts


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 10,
    batches: int = 4,
    fanout: int = 2,
    counts: tuple[str, str] | None = ("n_lines", "n_dropped"),
) -> DataFrame:
    """`docs` without the lines that a document with a smaller id has.

    A line is compared without blanks (space, tab to carriage return) at its ends and with
    A-Z in lower case. Lines that then have fewer than `min_chars` characters stay. All other
    lines keep their text and order; repeats within the smallest document stay.

    Null and empty texts are one empty line; their text becomes empty. Rows with equal ids
    are one document, as are all rows without an id, which come after all others. `counts`
    names columns for the lines before and the lines dropped; columns of these names are
    replaced, all other columns are kept.
    """
    runs = LineRuns(docs.sparkSession, fanout)
    dropped = None
    for part in batches_by_id(docs, doc_id, batches):
        lines = line_hashes(part, doc_id, text, min_chars)
        keys = lines.groupBy(*HASH).agg(F.min("__doc").alias("__first"))
        run = runs.add(keys).select(*[F.col(h).alias(f"{h}r") for h in HASH], "__first")
        same = [F.col(h) == F.col(f"{h}r") for h in HASH]
        first = F.col("__doc").eqNullSafe(F.col("__first"))
        gone = cut_lineage(
            lines.join(run, [*same, first], "left_anti").select(KEY, "__at")
        )
        dropped = gone if dropped is None else dropped.unionByName(gone)
    runs.close()
    key, gone, lines = (free_name(docs, name) for name in ("key", "gone", "lines"))
    places = dropped.select(F.col(KEY).alias(key), "__at").groupBy(key)
    places = places.agg(F.array_sort(F.collect_set("__at")).alias(gone))

    rows = docs.withColumn(key, row_key(doc_id, text)).join(places, key, "left")
    none = F.array().cast("array<int>")
    rows = rows.withColumn(lines, text_lines(F.col(text)))
    rows = rows.withColumn(gone, F.coalesce(gone, none))
    # What stays are the stretches between dropped lines.
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda at: at + 1))
    ends = F.concat(F.col(gone), F.array(F.size(lines)))
    kept = F.flatten(
        F.zip_with(starts, ends, lambda s, e: F.slice(F.col(lines), s + 1, e - s))
    )
    kept_text = F.when(F.size(gone) == 0, F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.array_join(kept, "\n")
    )
    rows = rows.withColumn(text, kept_text)
    names = list(docs.columns)
    for name, value in zip(counts or (), (F.size(lines), F.size(gone)), strict=False):
        rows = rows.withColumn(name, value.cast("long"))
        names += [name] if name not in names else []
    return rows.select(*[F.col(f"`{n}`") for n in names])
