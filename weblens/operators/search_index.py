"""Search stored logs by the files that can hold the term.

For each stored file the index has the set of trigrams of what a search looks at. What a term
must hold literally gives trigrams too; files without one of them cannot match and are not
opened, and the others are searched by `search_logs` itself, so the result is the same.

Letters are folded as a search folds them, for ASCII; a trigram with other characters is in no
index and asked of no file.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblens.operators.filters import SEARCHED, search_logs

# Signs that a search takes for an ASCII letter besides its two cases.
FOLDED_FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\u017f\u212a\u0130\u0131"
FOLDED_TO = "abcdefghijklmnopqrstuvwxyzskii"
GRAM = re.compile(r"[\x20-\x7e]{3}")
# What is taken off a term before its literal runs are read: classes, escapes, repetitions.
_CLASS = re.compile(r"\[(?:\\.|[^\]\\])+\]")
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)
_REPEATED = re.compile(r"(?s).(?:[*?]|\{[^}]*\})[+?]?")
_BREAKS = re.compile(r"[.^$+\x00-\x1f\x7f-\U0010ffff]+")
#: Expressions that say more than literal runs can: groups, flags, quotes, odd classes.
_BEYOND = re.compile(r"[()]|\\[QEcxu0-9NpPkXR]|\[[^\]]*[\[&]|\[\^?\]|#")


def folded(text: str) -> str:
    return text.translate(str.maketrans(FOLDED_FROM, FOLDED_TO))


def grams_of(text: str) -> set[str]:
    text = folded(text)
    return {text[i : i + 3] for i in range(len(text) - 2) if GRAM.fullmatch(text[i : i + 3])}


def required_grams(term: str, literal: bool = False) -> list[set[str]] | None:
    """The trigrams that each alternative of a term requires; None where that is not known."""
    if literal:
        grams = grams_of(term)
        return [grams] if grams else None
    if _BEYOND.search(term):
        return None
    found = []
    plain = _CLASS.sub("\0", re.sub(r"\\\\|\\\[|\\\]|\\\|", "\0", term))
    if "[" in plain or "]" in plain:
        return None
    for part in plain.split("|"):
        # An escaped sign stands for itself unless it is a letter or digit, such as \d.
        runs = _ESCAPE.sub(lambda m: "\0" if m[1].isalnum() or m[1] in ".^$+*?{}" else m[1], part)
        runs = _REPEATED.sub("\0", runs)
        if any(sign in runs for sign in "*?{}\\"):
            return None
        grams = set().union(*map(grams_of, _BREAKS.split(runs)))
        # A plus repeats what stands before it, which stays required once.
        if not grams:
            return None
        found.append(grams)
    return found


def _cells(columns: list[str]) -> Column:
    """What a search looks at, a cell a line."""
    return F.concat_ws("\n", *[F.col(c).cast("string") for c in SEARCHED if c in columns])


def build_search_index(spark: SparkSession, path: str, index: str, files: DataFrame | None = None) -> None:
    """Write `(gram, file_path)` of the table stored at `path`, sorted by trigram, to `index`.

    Each trigram of a file is one row. Ranges of trigrams make the files of the index, so a
    look-up reads few row groups. `files` (`file_path`) limits this to some stored files, for
    a table that grows: call it again with the new ones, and their rows are added.
    """
    logs = spark.read.parquet(path)
    logs = logs.withColumn("_file", F.col("_metadata.file_path"))
    if files is not None:
        names = [r.file_path for r in files.select("file_path").distinct().collect()]
        logs = logs.where(F.col("_metadata.file_path").isin(names))
    text = F.translate(_cells(logs.columns), FOLDED_FROM, FOLDED_TO)
    cells = logs.select(F.col("_file").alias("file_path"), F.explode(F.array(text)).alias("text"))
    cells = cells.where(F.char_length("text") >= 3)
    grams = F.expr("array_distinct(transform(sequence(1, char_length(text) - 2), i -> substr(text, i, 3)))")
    found = cells.select("file_path", F.explode(grams).alias("gram"))
    found = found.where(F.col("gram").rlike(r"^[\x20-\x7e]{3}$")).distinct()
    mode = "append" if files is not None else "overwrite"
    ordered = found.repartitionByRange("gram").sortWithinPartitions("gram", "file_path")
    ordered.select("gram", "file_path").write.mode(mode).parquet(index)


def candidate_files(spark: SparkSession, index: str, term: str, literal: bool = False) -> DataFrame | None:
    """`(file_path)` of the files that can hold the term; None where any can."""
    required = required_grams(term, literal)
    if not term or required is None:
        return None
    rows = [(n, gram) for n, grams in enumerate(required) for gram in sorted(grams)]
    wanted = spark.createDataFrame(rows, "part int, gram string")
    counts = [(n, len(grams)) for n, grams in enumerate(required)]
    needed = spark.createDataFrame(counts, "part int, needed long")
    every = sorted({gram for _, gram in rows})
    # A term is short, so its trigrams are broadcast and pushed down to the index.
    postings = spark.read.parquet(index).where(F.col("gram").isin(every)).distinct()
    held = postings.join(F.broadcast(wanted), "gram").groupBy("file_path", "part").count()
    whole = held.join(F.broadcast(needed), "part").where(F.col("count") == F.col("needed"))
    return whole.select("file_path").distinct()


def search_stored(
    spark: SparkSession, path: str, index: str, term: str, literal: bool = False
) -> DataFrame:
    """`search_logs` over the table stored at `path`, opening only files that can match.

    The names of those files pass through the driver, which lists stored files anyway.
    """
    logs = spark.read.parquet(path)
    files = candidate_files(spark, index, term, literal)
    if files is not None:
        names = [row.file_path for row in files.collect()]
        logs = logs.where(F.col("_metadata.file_path").isin(names)) if names else logs.limit(0)
    fields = [c for c in logs.columns if c != "log_date"]
    return search_logs(logs.select(*fields), term, literal)


__all__ = [
    "build_search_index",
    "candidate_files",
    "grams_of",
    "required_grams",
    "search_stored",
]
