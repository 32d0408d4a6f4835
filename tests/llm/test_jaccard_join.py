"""The join against all pairs, with lists and blocks so small that every path is taken."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from weblens.llm import jaccard_join as join
from weblens.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(rows):
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        yield {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists, sets = defaultdict(list), list(sets_of(rows))
    for k, (i, _) in enumerate(rows):
        if i is None:
            continue
        for j, both in Counter(j for s in sets[k] for j in lists[s]).items():
            if 100 * both >= 80 * (len(sets[k]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(rows[j][0])))
                parent[b] = a
        for s in sets[k]:
            lists[s].append(k)
    return sorted(
        str((i, len(s), None if i is None else root(i))) for (i, _), s in zip(rows, sets, strict=True)
    )


def make_rows(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(2000)]
    rows = [(None, None), (None, "a b c d e f"), (1, ""), (2, "  \n"), (3, "A b"), (4, "a B")]
    rows += [(5, "one"), (5, "one two three four five six"), (6, "one two three four five six"), (7, "one")]
    passages = [rng.choices(words, k=30) for _ in range(3)]
    for copies in (1, 2, 3, 8, 30):
        base = rng.choices(words, k=rng.randint(20, 90))
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, len(text) // 18)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    for _ in range(40):
        text = sum((rng.choice(passages) for _ in range(rng.randint(1, 3))), [])
        rows.append((len(rows), " ".join(text + rng.choices(words, k=rng.randint(0, 25)))))
    return rows + rows[-3:]


@pytest.mark.parametrize("most,block", [(4, 16), (32, 4096)])
def test_against_all_pairs(spark, monkeypatch, most, block):
    monkeypatch.setattr(join, "LIST_MOST", most)
    monkeypatch.setattr(join, "BLOCK", block)
    rows = make_rows(most)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = join.near_duplicates(docs.selectExpr("*", "1 AS n", "2 AS node")).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert join.near_duplicates(docs).count() == 0


def test_divide_skip():
    rng = np.random.default_rng(1)
    for need in (1, 3, 6):
        lists = [np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(9)]
        ids, times = join.divide_skip(np.zeros(0, np.int64), lists, need)
        all_ids, all_times = np.unique(np.concatenate(lists), return_counts=True)
        keep = all_times >= need
        assert dict(zip(ids, times, strict=True)) == dict(zip(all_ids[keep], all_times[keep], strict=True))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = components(spark.createDataFrame(links, "x long, y long"))
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert {r.node: r.label for r in got.collect()} == want


@pytest.mark.parametrize("most,block", [(2, 16), (32, 4096)])
def test_near_copies_of_any_text_of_an_id(spark, monkeypatch, most, block):
    monkeypatch.setattr(join, "LIST_MOST", most)
    monkeypatch.setattr(join, "BLOCK", block)
    word = lambda kind, n: [f"{kind}{k}" for k in range(n)]
    small, large, other = word("s", 14), word("l", 1004), word("o", 40)
    texts = [
        (5, small), (5, large), (6, small + ["more"]), (7, large + ["more"]),
        (3, other), (8, other), (8, word("p", 30)), (9, word("p", 30) + ["more"]),
        (-4, word("q", 50)), (11, word("q", 50) + ["more"]), (-4, word("r", 20)), (10, word("r", 20)),
        (12, word("t", 25)), (12, word("t", 25)), (13, word("t", 25) + ["more"]), (14, word("u", 9)),
    ]
    rows = [(i, " ".join(t)) for i, t in texts]
    got = join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)
    group = {r.doc_id: r.component_id for r in got}
    assert group == {5: 5, 6: 5, 7: 5, 3: 3, 8: 3, 9: 3, -4: -4, 11: -4, 10: -4, 12: 12, 13: 12, 14: 14}
