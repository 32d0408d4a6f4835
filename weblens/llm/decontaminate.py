"""Find benchmark phrases in a corpus with a positional inverted index.

Words are runs of ASCII letters and digits, A-Z in lower case, and of all characters beyond
ASCII. A benchmark item gives a window for each `window` consecutive words, or one window if
it is shorter.

1. Count in the whole corpus how often each benchmark word occurs.
2. For every window take its two rarest words. Windows with a word that never occurs cannot
   match and go. Windows of an item with the same two words at the same places go together.
3. Store the postings of these words: `(word, document, position)` and the words around.
4. Intersect the lists: the rarest word's postings, each shifted by the distance of the two
   words, with the postings of the second. A join on word, document and position, so neither
   a frequent word nor a long document is a hot key.
5. Compare the words around the second word with each window.

Each step reads all documents or all postings. Benchmark words reach the scan by broadcast, in
as many slices as keep each within the measured limit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblens.llm.common import KEY, lower_ascii, row_key
from weblens.shared import BROADCAST_LIMIT_BYTES, broadcast_within_limit, cut_lineage

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    lowered = lower_ascii(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, NO_WORD), "")


def windows_of(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """`(item, item_id, start, words)` of every window; equal rows of items count once."""
    rows = items.select(
        row_key(item_id, text).alias("item"),
        F.col(item_id).alias("item_id"),
        words_of(F.col(text)).alias("all"),
    ).where(F.size("all") > 0)
    last = F.greatest(F.size("all") - window, F.lit(0))
    starts = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("start"))
    return starts.select(
        "item", "item_id", "start", F.slice("all", F.col("start") + 1, window).alias("words")
    ).dropDuplicates(["item", "start"])


def _sliced(rows: DataFrame, words: DataFrame, limit_bytes: int) -> DataFrame:
    """`rows` whose `word` is in `words`, without shuffling rows whatever the size of words."""
    size = words.agg(F.sum(F.octet_length("word") + 48)).first()[0] or 0
    count = max(1, math.ceil(size / limit_bytes))
    found = None
    for i in range(count):
        part = words.where(F.pmod(F.xxhash64("word"), F.lit(count)) == i)
        kept = rows.join(F.broadcast(part), "word")
        found = kept if found is None else found.unionByName(kept)
    return found


def rarest_words(windows: DataFrame, frequencies: DataFrame) -> DataFrame:
    """A row per item and pair of places of a window's two rarest words.

    `(item, item_id, word1, at1, word2, at2, windows)`: places are counted in the item, and
    `windows` holds `(start, size, phrase)` of all windows with these two.
    """
    places = windows.select("*", F.posexplode("words").alias("at", "word"))
    ranked = places.join(frequencies, "word", "left")
    rank = F.struct(
        F.col("n"), (F.col("start") + F.col("at")).alias("at"), F.col("word").alias("word")
    )
    # A window is one row of at most `window` places, so this is a small, even group.
    picked = ranked.groupBy("item", "start").agg(
        F.first("item_id").alias("item_id"),
        F.first("words").alias("words"),
        F.bool_and(F.col("n").isNotNull()).alias("occurs"),
        F.array_sort(F.collect_list(rank)).alias("ranked"),
    )
    first = F.col("ranked")[0]
    second = F.coalesce(F.get("ranked", F.lit(1)), first)
    return (
        picked.where("occurs")
        .groupBy(
            "item",
            first["word"].alias("word1"),
            first["at"].alias("at1"),
            second["word"].alias("word2"),
            second["at"].alias("at2"),
        )
        .agg(
            F.first("item_id").alias("item_id"),
            F.collect_list(
                F.struct(
                    "start",
                    F.size("words").alias("size"),
                    F.array_join("words", " ").alias("phrase"),
                )
            ).alias("windows"),
        )
    )


def build_postings(
    docs: DataFrame, words: DataFrame, doc_id: str, text: str, radius: int, limit_bytes: int
) -> DataFrame:
    """`(word, key, doc_id, pos, from, around)` of each place of `words`, written to a table.

    `around` holds the words up to `radius` before and after, from place `from` on.
    """
    places = docs.select(
        row_key(doc_id, text).alias(KEY),
        F.col(doc_id).alias("doc_id"),
        words_of(F.col(text)).alias("all"),
    ).select("*", F.posexplode("all").alias("pos", "word"))
    found = _sliced(places, words, limit_bytes)
    low = F.greatest(F.col("pos") - radius, F.lit(0))
    around = F.array_join(F.slice("all", low + 1, F.col("pos") + radius - low + 1), " ")
    return cut_lineage(
        found.select("word", KEY, "doc_id", "pos", low.alias("from"), around.alias("around"))
    )


def word_frequencies(
    docs: DataFrame, words: DataFrame, text: str, limit_bytes: int
) -> DataFrame:
    """`(word, n)`: how often each of `words` occurs in all documents; those that do."""
    places = docs.select(F.explode(words_of(F.col(text))).alias("word"))
    found = _sliced(places, words, limit_bytes)
    return cut_lineage(found.groupBy("word").agg(F.count("*").alias("n")))


def _index(docs, items, doc_id, text, item_id, item_text, window, radius, limit_bytes):
    """Pairs of rarest words of all windows, and the postings of these words."""
    windows = cut_lineage(windows_of(items, item_id, item_text, window))
    words = cut_lineage(windows.select(F.explode("words").alias("word")).distinct())
    pairs = cut_lineage(rarest_words(windows, word_frequencies(docs, words, text, limit_bytes)))
    anchors = pairs.select(F.explode(F.array("word1", "word2")).alias("word")).distinct()
    postings = build_postings(docs, cut_lineage(anchors), doc_id, text, radius, limit_bytes)
    return pairs, postings


def phrase_matches(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """`(__row_key, doc_id, item_id, at, size)`: every place where a window's words occur.

    `at` is the first word's place in the document. Places of repeated rows appear once.
    """
    pairs, postings = _index(
        docs, items, doc_id, text, item_id, item_text, window, window - 1, limit_bytes
    )
    rarest = postings.select(F.col("word").alias("word1"), KEY, "pos")
    shift = F.col("pos") - F.col("at1")
    moved = rarest.join(broadcast_within_limit(pairs, limit_bytes), "word1").select(
        KEY,
        F.col("word2").alias("word"),
        (shift + F.col("at2")).alias("pos"),
        shift.alias("shift"),
        "item_id",
        "windows",
    )
    met = moved.join(postings, [KEY, "word", "pos"])
    tried = met.select(KEY, "doc_id", "item_id", "shift", "from", "around", F.inline("windows"))
    at = F.col("shift") + F.col("start")
    first = F.greatest(at - F.col("from") + 1, F.lit(1))
    seen = F.array_join(F.slice(F.split("around", " "), first, F.col("size")), " ")
    hit = (at >= F.col("from")) & (seen == F.col("phrase"))
    return tried.where(hit).select(KEY, "doc_id", "item_id", at.alias("at"), "size").distinct()


def near_matches(
    docs: DataFrame,
    items: DataFrame,
    slack: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """`(__row_key, doc_id, item_id, start, pos)`: windows whose words all occur, in any order,
    within `slack` more words than the window has, around the place `pos` of its rarest word.
    """
    radius = window + slack - 1
    pairs, postings = _index(
        docs, items, doc_id, text, item_id, item_text, window, radius, limit_bytes
    )
    rarest = postings.withColumnRenamed("word", "word1")
    tried = rarest.join(broadcast_within_limit(pairs, limit_bytes), "word1").select(
        KEY, "doc_id", "item_id", "pos", "from", F.split("around", " ").alias("near"),
        F.inline("windows"),
    )
    terms = F.array_distinct(F.split("phrase", " "))
    span = F.col("size") + slack
    within = F.exists(
        F.sequence(F.lit(1), F.greatest(F.size("near") - span + 1, F.lit(1))),
        lambda low: (low <= F.col("pos") - F.col("from") + 1)
        & (low + span > F.col("pos") - F.col("from") + 1)
        & (F.size(F.array_except(terms, F.slice("near", low, span))) == 0),
    )
    return tried.where(within).select(KEY, "doc_id", "item_id", "start", "pos").distinct()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = 20,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """`(__row_key, doc_id, n_words, n_hit, items, contaminated)` for every row of `docs`.

    `n_hit` counts the words inside any occurrence of a window, `items` holds the ids of items
    with one, as sorted texts. A row is contaminated if it has a hit word and at least one
    word in `share` is hit.

    Null and empty texts have no words and no hits. Items without words are never found; an
    item without an id marks words but has no id to report. Repeated items count once,
    repeated rows each give a row. Only the named columns are read.
    """
    matches = phrase_matches(
        docs, items, doc_id, text, item_id, item_text, window, limit_bytes
    )
    matches = cut_lineage(matches)
    before = Window.partitionBy(KEY).orderBy("at", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(
        F.col("end") - F.greatest(F.col("at"), F.coalesce(F.max("end").over(before), F.lit(0))),
        F.lit(0),
    )
    places = matches.select(KEY, "at", (F.col("at") + F.col("size")).alias("end")).distinct()
    hit = places.withColumn("covered", covered).groupBy(KEY).agg(F.sum("covered").alias("n_hit"))
    found = matches.groupBy(KEY).agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    rows = docs.select(
        row_key(doc_id, text).alias(KEY),
        F.col(doc_id).alias("doc_id"),
        F.size(words_of(F.col(text))).cast("long").alias("n_words"),
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    enough = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return (
        rows.join(hit.join(found, KEY), KEY, "left")
        .withColumn("n_hit", n_hit)
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .withColumn("contaminated", enough)
    )
