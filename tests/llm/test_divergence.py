"""Distances and telling terms of sources against plain loops over all terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from weblens.llm import divergence
from weblens.llm.divergence import source_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=30, most=50):
    docs = [(r[1] or "", r[2] or "", TERM.findall((r[0] or "").translate(LOWER))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t, n in held.items() if n >= least)
        used = defaultdict(Counter)
        for _, source, terms in mine:
            used[source].update(terms)

        def values(counter, kept=kept):
            size = sum(counter[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counter[t] + 5) // size for t in kept}

        p = {s: values(c) for s, c in used.items()}
        q = values(sum(used.values(), Counter()))
        for s in p:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in p if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if used[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:most])):
                for rank, (value, item) in enumerate(found, 1):
                    out.append((lang, s, part, item.decode(), -value, rank))
    return sorted(out)


def got(df):
    columns = ("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(r) for r in df.select(*columns).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


def some_rows(n, seed=3, sources=5):
    rng = random.Random(seed)
    words = ["the", "Ärger", "ça", "of", "x", "ZZ", "über", "日本語", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = []
    for _ in range(n):
        source = rng.randrange(sources)
        some = words[source : source + 9] + words[:3]
        text = rng.choice([" ", ", ", "\n", "3"]).join(rng.choices(some, k=rng.randrange(60)))
        rows.append((text, rng.choice(["en", "de", "de"]), f"s{source}"))
    return rows


@pytest.mark.parametrize("seed", [3, 4])
def test_against_plain_loops(spark, seed):
    rows = some_rows(400, seed)
    assert got(source_divergence(frame(spark, rows))) == brute(rows)


def test_blocks_and_slices_do_not_matter(spark, monkeypatch):
    rows = some_rows(400, sources=17)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 4)
    monkeypatch.setattr(divergence, "LEAST_SLICES", 3)
    assert got(source_divergence(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, None, None)] * 3 + [("", "xx", "a"), ("one two", "xx", "b"), ("!!!", "yy", None)]
    rows += [("Word of " * 5, "en", "a")] * 40 + [("word " * 30000, "en", "b"), (None, "en", "c")]
    docs = frame(spark, rows).selectExpr("*", "1 AS n", "2 AS p", "3 AS value", "'t' AS term")
    assert got(source_divergence(docs)) == brute(rows)
    assert got(source_divergence(docs.limit(0))) == []


def test_all_at_one_source(spark):
    """A source with nearly all rows, and ties that go to the smaller name."""
    rows = [("same words here", "en", "big")] * 300 + [("same words here", "en", s) for s in "cab"]
    found = got(source_divergence(frame(spark, rows)))
    assert found == brute(rows)
    ranks = {r[3]: r[5] for r in found if r[1] == "b" and r[2] == "pair"}
    assert ranks == {"a": 1, "big": 2, "c": 3}


def test_parts_of_long_texts(monkeypatch):
    raw = ("Ab cé-d " * 50).encode()
    whole = [t for part in divergence.term_parts(raw) for t in part]
    monkeypatch.setattr(divergence, "PART_BYTES", 5)
    assert [t for part in divergence.term_parts(raw) for t in part] == whole


def test_scatter_in_parts(monkeypatch):
    index = {
        "sources": np.array([0, 1, 0, 1]),
        "p": np.array([9, 4, 7, 2]),
        "starts": np.array([0, 2]),
        "sizes": np.array([2, 2]),
    }
    row = {"terms": np.array([0, 1]), "p": np.array([9, 7])}
    results = []
    for size in (1, 100):
        monkeypatch.setattr(divergence, "SCATTERED", size)
        acc = np.zeros(2, np.int64)
        divergence._scatter(row, index, np.array([1, 1]), 0, acc)
        results.append(acc.tolist())
    assert results[0] == results[1] == [-28, -8]
