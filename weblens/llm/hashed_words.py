"""Words of Arrow texts as 64-bit hashes, worked out for whole buffers at a time.

The hash of a byte string b is sum(b[i] * P**i) modulo 2**64, mixed at the end. As P is odd it
has an inverse, so hashes of all words of a buffer come out of one running sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

P = 0x9E3779B97F4A7C15
P_INVERSE = pow(P, -1, 1 << 64)
# Buffers are worked on in parts of about so many bytes, cut between words.
PART_BYTES = 1 << 18

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) <= n:
        size = max(PART_BYTES, n) + 1
        for k, base in enumerate((P, P_INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true within the ranges, ends included."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


BLANK = byte_class((0x20, 0x20), (0x09, 0x0D))
NO_WORD = byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where its rows begin and end; null as empty."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    if not n or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def row_slices(column: pa.Array, most_bytes: int = 4 << 20) -> Iterator[pa.Array]:
    """A text column in runs of rows of about `most_bytes`; a longer text is a run of its own."""
    ends = text_bytes(column)[1]
    low = 0
    while low < len(column):
        high = int(np.searchsorted(ends, ends[low] + most_bytes, "right")) - 1
        high = max(high, low + 1)
        yield column.slice(low, high - low)
        low = high


class Words:
    """Words of a run of bytes: where they begin and end, and their hashes."""

    def __init__(self, raw: np.ndarray, rows: np.ndarray, separators: np.ndarray):
        """`rows` are places where a row begins: no word reaches over them."""
        inside = ~separators[raw]
        n = len(raw)
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        rows = rows[(rows > 0) & (rows < n)]
        begins[rows] = inside[rows]
        ends[rows - 1] = inside[rows - 1]
        self.begins = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        power, self._inverse = _power_tables(n)
        values = LOWER[raw].astype(np.uint64)
        values += np.uint64(1)
        values *= power[:n]
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values, out=self._sums[1:])

    def hashes(self, most: int | None = None) -> np.ndarray:
        """Hashes of the words, or of their first `most` bytes, A-Z in lower case."""
        ends = self.ends if most is None else np.minimum(self.ends, self.begins + most)
        return mix((self._sums[ends] - self._sums[self.begins]) * self._inverse[self.begins])


def parts(raw: np.ndarray, separators: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about `PART_BYTES`, none of which ends within a word."""
    low, n = 0, len(raw)
    while low < n:
        high = min(low + PART_BYTES, n)
        while high < n:
            gaps = np.flatnonzero(separators[raw[low:high]])
            if len(gaps):
                high = low + int(gaps[-1]) + 1
                break
            high = min(high + PART_BYTES, n)  # one word is longer than a part
        yield low, high
        low = high


def word_hashes(column: pa.Array, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and how many words the rows up to each one have."""
    raw, rows = text_bytes(column)
    hashes, begins = [], []
    for low, high in parts(raw, separators):
        words = Words(raw[low:high], rows - low, separators)
        hashes.append(words.hashes())
        begins.append(words.begins + low)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(rows), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), rows)
