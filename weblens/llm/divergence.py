"""How far the sources of a language differ in the terms they use, exactly.

A term is a run of letters and characters beyond ASCII, A-Z in lower case. A language keeps the
terms that at least `LEAST_DOCS` of its rows hold; a source gives each kept term a smoothed
whole number p, also the terms it never uses, for which p is its baseline z.

The distance of two sources is the sum of |p - p'| over all kept terms. It is gathered as
Gustavson multiplies sparse matrices, row by row: a source scatters its own terms through the
term-major index into one dense accumulator over its peers; no posting pair is emitted. What
the baselines add is corrected: with all terms at the baselines the distance is
V * |z - z'|; a term of one side changes that by |p - z'| - |z - z'|, summed from sorted values
with running sums, and a term of both by |p - p'| - |p - z'| - |z - p'| + |z - z'|.

The work is cut by slices of terms and, where a language has many sources, by blocks of
sources, so what a task holds is bounded, and no term or source lands in one task whole.

Null texts, languages and sources count as ''. Each row is a document of its own, so repeated
rows count repeatedly. An empty table gives no rows; a language without kept terms has
distances of 0 and no terms. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblens.llm.common import share
from weblens.llm.hashed_words import row_slices
from weblens.shared import broadcast_within_limit, cut_lineage

LEAST_DOCS = 30
SMOOTHING = 5
MOST_TERMS = 50
# Entries a worker counts before it gives them away, and how long the parts of a text are.
COUNTED_ENTRIES = 200_000
PART_BYTES = 1 << 20
# Sources in a block, postings in a slice of terms, slices at least, and postings that are
# scattered at once (their sum stays exact in double precision).
BLOCK_SOURCES = 512
SLICE_POSTINGS = 1_000_000
LEAST_SLICES = 32
SCATTERED = 1 << 18

LETTERS_ONLY = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
COUNTS = pa.schema(
    [
        ("lang", pa.string()),
        ("source", pa.string()),
        ("term", pa.string()),
        ("n", pa.int64()),
        ("docs", pa.int64()),
    ]
)


def term_parts(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, some at a time."""
    plain = raw.translate(LETTERS_ONLY)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + PART_BYTES)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by language and source, and each group itself."""
    used: dict[tuple, Counter] = {}
    held: dict[tuple, Counter] = {}
    groups: set[tuple] = set()

    def flush() -> Iterator[pa.RecordBatch]:
        for group in groups:
            used.setdefault(group, Counter())
        for (lang, source), counter in used.items():
            found = held.get((lang, source), {})
            group = (lang, source)
            alone = [None] if group in groups else []
            terms = [*alone, *(t.decode("utf-8", "replace") for t in counter)]
            n = [0] * len(alone) + list(counter.values())
            docs = [0] * len(alone) + [found[t] for t in counter]
            columns = [[lang] * len(n), [source] * len(n), terms, n, docs]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, COUNTS, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=COUNTS)
        used.clear()
        held.clear()
        groups.clear()

    seen: set[tuple] = set()
    entries = 0
    for batch in batches:
        langs, sources = (batch.column(i).to_pylist() for i in (0, 1))
        at = 0
        for part in row_slices(batch.column(2)):
            for raw in part.cast(pa.binary()).to_pylist():
                group = (langs[at], sources[at])
                at += 1
                if group not in seen:
                    seen.add(group)
                    groups.add(group)
                if not raw:
                    continue
                mine = used.setdefault(group, Counter())
                docs = held.setdefault(group, Counter())
                before = len(mine)
                distinct: set[bytes] = set()
                for terms in term_parts(raw):
                    mine.update(terms)
                    distinct.update(terms)
                docs.update(distinct)
                entries += len(mine) - before
                if entries >= COUNTED_ENTRIES:
                    yield from flush()
                    entries = 0
    yield from flush()


def count_terms(docs: DataFrame) -> DataFrame:
    """`(lang, source, term, n, docs)`; each group also has a row with a null term."""
    share(docs.sparkSession, None)
    plain = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    schema = "lang string, source string, term string, n long, docs long"
    counted = plain.mapInArrow(_count_terms, schema)
    return counted.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def smoothed(n: str, size: str, kept: str) -> Column:
    """The whole number p of a term that occurs `n` times among `size`, of `kept` terms.

    Decimals, as a thousand million times a count may leave 64 bits. 0 where no term is kept.
    """
    return F.expr(
        f"CASE WHEN {kept} = 0 THEN 0L ELSE 1L + ((1000000000BD * (CAST({n} AS DECIMAL(20,0))"
        f" + {SMOOTHING}BD)) div (CAST({size} AS DECIMAL(20,0))"
        f" + {SMOOTHING}BD * CAST({kept} AS DECIMAL(20,0)))) END"
    )


def _scatter(row: dict, index: dict, z: np.ndarray, own: int, acc: np.ndarray) -> None:
    """Add to `acc` what a source and its peers have in common, through the term-major index."""
    starts, sizes = index["starts"][row["terms"]], index["sizes"][row["terms"]]
    ends = np.cumsum(sizes)
    low = 0
    while low < len(starts):
        done = ends[low - 1] if low else 0
        high = max(int(np.searchsorted(ends, done + SCATTERED, "right")), low + 1)
        size = sizes[low:high]
        begins = np.repeat(starts[low:high] - (ends[low:high] - size - done), size)
        at = begins + np.arange(len(begins))
        peer, theirs = index["sources"][at], index["p"][at]
        mine, base = np.repeat(row["p"][low:high], size), z[peer]
        change = (
            np.abs(mine - theirs)
            - np.abs(mine - base)
            - np.abs(z[own] - theirs)
            + np.abs(z[own] - base)
        )
        acc += np.bincount(peer, weights=change, minlength=len(acc)).astype(np.int64)
        low = high


def _one_sided(values: np.ndarray, z: np.ndarray, own: int) -> np.ndarray:
    """Sum over a source's own terms of |p - z'| - |z - z'|, for the baseline z' of each peer."""
    values = np.sort(values)
    sums = np.concatenate([[0], np.cumsum(values)])
    below = np.searchsorted(values, z, "right")
    n = len(values)
    apart = z * below - sums[below] + (sums[n] - sums[below]) - z * (n - below)
    return apart - n * np.abs(z[own] - z)


DISTANCES = pa.schema(
    [
        ("lang", pa.string()),
        ("source", pa.string()),
        ("item", pa.string()),
        ("q", pa.int64()),
        ("value", pa.int64()),
    ]
)


def _accumulate(key: tuple, table: pa.Table) -> pa.Table:
    """Distances over one slice of terms between the sources of two blocks."""
    lang, slice_no, left, right = (k.as_py() for k in key)
    coded = table["source"].combine_chunks().dictionary_encode()
    names, source = coded.dictionary, coded.indices.to_numpy()
    n = len(names)
    block = table["block"].to_numpy()
    values = table["p"].to_numpy()
    head = np.asarray(table["term"].is_null())
    z, block_of, kept = (np.zeros(n, np.int64) for _ in range(3))
    z[source[head]] = values[head]
    block_of[source[head]] = block[head]
    kept[source[head]] = table["kept"].to_numpy()[head]

    terms = table["term"].combine_chunks().filter(pa.array(~head)).dictionary_encode()
    term, source, values = terms.indices.to_numpy(), source[~head], values[~head]
    peer = block_of[source] == right
    order = np.lexsort((source[peer], term[peer]))
    sizes = np.bincount(term[peer], minlength=len(terms.dictionary))
    index = {
        "sources": source[peer][order],
        "p": values[peer][order],
        "sizes": sizes,
        "starts": np.cumsum(sizes) - sizes,
    }
    by_source = np.argsort(source, kind="stable")
    ends = np.cumsum(np.bincount(source, minlength=n))
    rows = [
        {"terms": term[at], "p": values[at]}
        for at in np.split(by_source, ends[:-1] if n else [])
    ]
    alone = np.array([_one_sided(r["p"], z, i) for i, r in enumerate(rows)]).reshape(n, n)

    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    cols = np.flatnonzero(block_of == right)
    for own in np.flatnonzero(block_of == left):
        acc = np.zeros(n, np.int64)
        _scatter(rows[own], index, z, own, acc)
        acc += alone[own] + alone[:, own]
        if slice_no == 0:
            acc += kept[own] * np.abs(z[own] - z)
        peers = cols[cols != own]
        if slice_no:  # every pair has its row in the first slice
            peers = peers[acc[peers] != 0]
        mine = np.full(len(peers), own)
        out.append((mine, peers, acc[peers]))
        if left != right:
            out.append((peers, mine, acc[peers]))
    a, b, value = (np.concatenate([o[i] for o in out] or [[]]).astype(np.int64) for i in range(3))
    arrays = [
        pa.array([lang] * len(a), pa.string()),
        names.take(pa.array(a)),
        names.take(pa.array(b)),
        pa.array(z[b]),
        pa.array(value),
    ]
    return pa.Table.from_arrays(arrays, schema=DISTANCES)


def distances(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """`(lang, source, item, q, value)` for each two sources of a language, both ways round.

    `kept` is `(lang, source, term, p)` of the terms that occur, `groups` is
    `(lang, source, z, kept)` with each source's baseline and its language's number of terms.
    Both are written tables.
    """
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    blocks = math.ceil(most / BLOCK_SOURCES)
    slices = max(LEAST_SLICES, math.ceil(kept.count() / SLICE_POSTINGS))
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).alias("block")
    entries = kept.select(
        "lang",
        F.pmod(F.xxhash64("term"), F.lit(slices)).alias("slice"),
        "source",
        block,
        "term",
        "p",
        F.lit(0).cast("long").alias("kept"),
    )
    heads = groups.select(
        "lang",
        F.explode(F.expr(f"sequence(0L, {slices - 1}L)")).alias("slice"),
        "source",
        block,
        F.lit(None).cast("string").alias("term"),
        F.col("z").alias("p"),
        "kept",
    )
    other = F.explode(F.expr(f"sequence(0L, {blocks - 1}L)"))
    both = entries.unionByName(heads).withColumn("other", other)
    both = both.withColumn("left", F.least("block", "other"))
    both = both.withColumn("right", F.greatest("block", "other")).drop("other")
    cells = both.groupBy("lang", "slice", "left", "right")
    schema = "lang string, source string, item string, q long, value long"
    parts = cells.applyInArrow(_accumulate, schema)
    return parts.groupBy("lang", "source", "item").agg(
        F.first("q").alias("q"), F.sum("value").alias("value")
    )


def source_divergence(docs: DataFrame) -> DataFrame:
    """`(lang, source, part, item, q, p, value, rank)` of every group of language and source.

    Part `pair` ranks all other sources of the language by their distance (`q` is null there),
    part `term` at most `MOST_TERMS` terms that the group uses more than its language does, by
    p - q. Ties go to the item that is first in UTF-8.
    """
    counts = cut_lineage(count_terms(docs))
    terms = counts.where("term IS NOT NULL").groupBy("lang", "term")
    terms = terms.agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    terms = cut_lineage(terms.where(F.col("docs") >= LEAST_DOCS).drop("docs"))
    used = counts.where("term IS NOT NULL").drop("docs")
    used = cut_lineage(used.join(broadcast_within_limit(terms), ["lang", "term"]))

    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_n"))
    sizes = used.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = counts.where("term IS NULL").select("lang", "source")
    groups = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["size", "kept", "lang_n"])
    groups = groups.withColumn("z", smoothed("0", "size", "kept"))
    groups = cut_lineage(groups)

    valued = used.join(broadcast_within_limit(groups), ["lang", "source"])
    valued = valued.withColumn("p", smoothed("n", "size", "kept"))
    valued = valued.withColumn("q", smoothed("total", "lang_n", "kept"))

    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = distances(valued.select("lang", "source", "term", "p"), groups)
    pairs = pairs.select(
        "lang",
        "source",
        F.lit("pair").alias("part"),
        "item",
        F.lit(None).cast("long").alias("q"),
        F.lit(None).cast("long").alias("p"),
        "value",
        F.row_number().over(by).alias("rank"),
    )
    more = valued.where("p > q").select(
        "lang",
        "source",
        F.lit("term").alias("part"),
        F.col("term").alias("item"),
        "q",
        "p",
        (F.col("p") - F.col("q")).alias("value"),
    )
    more = more.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= MOST_TERMS)
    return pairs.unionByName(more)
