"""Sets of hashed five-word shingles, as sorted arrays of 64-bit values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from weblens.llm.hashed_words import BLANK, P, mix, word_hashes

WORDS = 5
#: One odd factor per place of a word in its shingle, from a rule.
FACTORS = [np.uint64(pow(P, k + 2, 1 << 64)) for k in range(WORDS)]


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, in ascending order.

    Words are runs of characters other than blanks, A-Z in lower case. A text of fewer words
    has its whole sequence as its one shingle; a text without words, or null, has none.
    """
    words, ends = word_hashes(column, BLANK)
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    n = len(words)
    sums = np.zeros(n, np.uint64)
    for k, factor in enumerate(FACTORS):
        sums += padded[k : n + k] * factor
    sums = mix(sums)
    for low, high in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        count = high - low
        if count >= WORDS:
            yield np.unique(sums[low : high - WORDS + 1])
        elif count:
            short = [words[low + k : low + k + 1] * FACTORS[k] for k in range(count)]
            yield mix(sum(short[1:], short[0]) + np.uint64(count))
        else:
            yield words[:0]


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed values."""
    first = mix(shingles + np.uint64(1)).sum(dtype=np.uint64)
    second = np.bitwise_xor.reduce(mix(shingles ^ np.uint64(P)), initial=np.uint64(0))
    return int(first.view(np.int64)), int(second.view(np.int64))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share: each of the shorter is probed in the longer."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0
