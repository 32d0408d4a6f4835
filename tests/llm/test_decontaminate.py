"""Phrases and contamination against a brute-force scan."""

import random
import re

import pytest

from weblens.llm.decontaminate import contamination, near_matches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window):
    phrases = set()
    for item, text in items:
        w = words(text)
        for s in range(max(len(w) - window, 0) + 1 if w else 0):
            phrases.add((item, tuple(w[s : s + window])))
    out = []
    for i, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, phrase in phrases:
            n = len(phrase)
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) == phrase:
                    hit.update(range(s, s + n))
                    found |= {str(item)} if item is not None else set()
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(map(str, out))


@pytest.fixture
def rows():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "é", "Σ", "日本"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(15)]
    items += [items[3], (None, "w1 w2 w3"), (40, None), (41, "!?"), (42, "w5 w5 w5 w5 w5 w5")]
    docs = []
    for i in range(40):
        w = rng.choices(vocabulary, k=rng.randint(0, 60))
        if i % 2:
            w[len(w) // 2 : len(w) // 2] = [rng.choice(items[:15])[1].upper()]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    docs += [docs[1], docs[1], (1, "w5 " * 30), (None, None), (None, "w1-w2-w3"), (60, "")]
    return docs, items


@pytest.mark.parametrize("limit", [1 << 20, 400])
def test_contamination(spark, rows, limit):
    docs, items = rows
    got = contamination(
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n_hit"),
        spark.createDataFrame(items, "item_id long, text string"),
        window=5,
        limit_bytes=limit,
    )
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got.collect()]
    assert sorted(map(str, got)) == brute(docs, items, 5)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination(docs.limit(0), items).count() == 0
    row = contamination(docs, items.limit(0)).first()
    assert (row.n_words, row.n_hit, row["items"], row.contaminated) == (2, 0, [], False)


def test_near_matches(spark):
    docs = spark.createDataFrame(
        [(1, "one two x three"), (2, "three two one"), (3, "one x x x x x two three"), (4, "one two")],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(7, "one two three")], "item_id long, text string")
    got = near_matches(docs, items, slack=1)
    assert sorted(r.doc_id for r in got.collect()) == [1, 2]
