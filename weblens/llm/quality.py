"""A quality classifier from trusted positives and unlabelled text.

Learning minimises the non-negative unbiased risk of Kiryo et al. (2017): with the class prior
p of good text, the risk on negatives is estimated as risk on unlabelled text minus p times the
positives' share of it, and is not let below zero (where it is, the step goes back up). No
negative label is used, neither for fitting nor for the prior.

The prior is estimated from the same two samples: a first model separates positives from
unlabelled text; where it finds positives likeliest, unlabelled text is nearly all good, and
the ratio of the two distributions there tends to the prior.

A text becomes a row of figures about its words, characters, repetitions and lines, worked out
with numpy over whole texts; a small network with one hidden layer scores them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblens.llm.common import share
from weblens.llm.folds import sample_ids, sampled
from weblens.llm.hashed_words import BLANK, Words, byte_class, mix, parts, row_slices, text_bytes

THRESHOLD = 0.7
# At most so many trusted positives, and as many unlabelled rows, are learnt from.
MOST_ROWS = 4000
HIDDEN, STEPS, BATCH, RATE = 16, 1000, 256, 0.01

UPPER, DIGIT = byte_class((0x41, 0x5A)), byte_class((0x30, 0x39))
LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
PUNCTUATION = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
SIGNS = np.flatnonzero(PUNCTUATION)
NEWLINE = byte_class((0x0A, 0x0A))


def _per_row(row: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(row, weights, n).astype(float)


def _distinct(hashes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """How many different hashes each row has."""
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return _per_row(r[new], n)


def text_figures(column: pa.Array) -> np.ndarray:
    """A row of figures per text, all from 0 to about 1; zeros for null and empty texts."""
    raw, rows = text_bytes(column)
    n = len(rows) - 1
    hashes, row_of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    lines, line_row = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    signs = np.zeros((n, len(SIGNS)))
    upper_words, single, chars = np.zeros(n), np.zeros(n), np.zeros((n, 5))
    for low, high in parts(raw, NEWLINE):
        part = raw[low:high]
        words = Words(part, rows - low, BLANK)
        row = np.searchsorted(rows, words.begins + low, "right") - 1
        hashes.append(words.hashes())
        row_of.append(row)
        ends = np.searchsorted(SIGNS, part[words.ends - 1])
        ends = np.minimum(ends, len(SIGNS) - 1)
        signed = SIGNS[ends] == part[words.ends - 1]
        at = row[signed] * len(SIGNS) + ends[signed]
        signs += np.bincount(at, minlength=n * len(SIGNS)).reshape(n, len(SIGNS))
        long_words = words.ends - words.begins > 1
        first_two = UPPER[part[words.begins]] & UPPER[part[words.begins + long_words]]
        upper_words += _per_row(row[first_two & long_words], n)
        single += _per_row(row[~long_words], n)
        for k, table in enumerate((UPPER, DIGIT, LETTER, PUNCTUATION, NEWLINE)):
            places = np.flatnonzero(table[part]) + low
            chars[:, k] += np.diff(np.searchsorted(places, rows))
        own = Words(part, rows - low, NEWLINE)
        lines.append(own.hashes())
        line_row.append(np.searchsorted(rows, own.begins + low, "right") - 1)
    h, row = np.concatenate(hashes), np.concatenate(row_of)
    count = np.maximum(_per_row(row, n), 1)
    together = row[1:] == row[:-1]
    same = together & (h[1:] == h[:-1])
    pairs = mix(h[1:] * np.uint64(3) + h[:-1])[together]
    line, line_at = np.concatenate(lines), np.concatenate(line_row)
    line_count = np.maximum(_per_row(line_at, n), 1)
    size = np.maximum(np.diff(rows), 1)
    figures = [
        signs / count[:, None],
        chars / size[:, None],
        np.stack(
            [
                upper_words / count,
                single / count,
                _per_row(row[1:][same], n) / count,
                1 - _distinct(h, row, n) / count,
                1 - _distinct(pairs, row[1:][together], n) / np.maximum(count - 1, 1),
                1 - _distinct(line, line_at, n) / line_count,
                np.minimum(size / count / 20, 1),
                np.log1p(count) / 12,
                np.minimum(count / line_count / 100, 1),
            ],
            1,
        ),
    ]
    figures = np.concatenate(figures, 1)
    figures[np.diff(rows) == 0] = 0
    return figures


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    shift: np.ndarray
    outer: np.ndarray
    bias: np.ndarray
    prior: float

    def logits(self, figures: np.ndarray) -> np.ndarray:
        x = np.clip((figures - self.mean) / self.scale, -8, 8)
        # Matrix products round a row by its place among others; these sums do not.
        hidden = np.tanh(np.einsum("ij,jk->ik", x, self.inner) + self.shift)
        return np.einsum("ij,j->i", hidden, self.outer) + self.bias[0]

    def scores(self, column: pa.Array) -> np.ndarray:
        found = [self.logits(text_figures(part)) for part in row_slices(column)]
        return 1 / (1 + np.exp(-np.concatenate([np.zeros(0), *found])))


def _blank(figures: np.ndarray, prior: float, rng) -> Model:
    width = figures.shape[1]
    mean = figures.mean(0) if len(figures) else np.zeros(width)
    scale = figures.std(0) + 1e-2 if len(figures) else np.ones(width)
    inner = rng.normal(0, 0.3, (width, HIDDEN))
    outer = rng.normal(0, 0.3, HIDDEN)
    return Model(mean, scale, inner, np.zeros(HIDDEN), outer, np.zeros(1), prior)


def _sigmoid(z):
    return 1 / (1 + np.exp(-z))


def fit(good: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Minimise the non-negative risk with the logistic loss, by Adam on mixed batches."""
    rng = np.random.default_rng(seed)
    model = _blank(np.concatenate([good, unlabelled]), prior, rng)
    if not len(good) or not len(unlabelled):
        return model
    values = [model.inner, model.shift, model.outer, model.bias]
    state = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    step = 0
    steps = max(1, max(len(good), len(unlabelled)) // BATCH)
    for _ in range(max(1, STEPS // steps)):
        g_parts = np.array_split(rng.permutation(len(good)), steps)
        u_parts = np.array_split(rng.permutation(len(unlabelled)), steps)
        for gi, ui in zip(g_parts, u_parts, strict=True):
            if not len(gi) or not len(ui):
                continue
            x = np.concatenate([good[gi], unlabelled[ui]])
            x = np.clip((x - model.mean) / model.scale, -8, 8)
            hidden = np.tanh(x @ model.inner + model.shift)
            z = hidden @ model.outer + model.bias[0]
            zg, zu = z[: len(gi)], z[len(gi) :]
            # Loss of a negative is log(1 + e^z), of a positive log(1 + e^-z).
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zg).mean()
            as_negative_g = -prior * _sigmoid(zg) / len(gi)
            as_negative_u = _sigmoid(zu) / len(ui)
            if negative >= 0:
                dg = -prior * (1 - _sigmoid(zg)) / len(gi) + as_negative_g
                du = as_negative_u
            else:  # more certain about negatives than the prior allows
                dg, du = -as_negative_g, -as_negative_u
            d = np.concatenate([dg, du])
            back = np.outer(d, model.outer) * (1 - hidden**2)
            gradients = [x.T @ back, back.sum(0), hidden.T @ d, np.array([d.sum()])]
            step += 1
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for v, g, (m, s) in zip(values, gradients, state, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (np.sqrt(s) + 1e-8) + 0.01 * v)
    return model


def estimate_prior(good: np.ndarray, unlabelled: np.ndarray, seed: int = 7) -> float:
    """The share of good text among unlabelled text.

    Half of each sample separates the two; on the other half the share of unlabelled rows over
    a score is compared with the share of positives over it. Text that is not good only adds
    to the former, least where the score is highest; the smallest ratio is taken over
    scores that at least a fifth of the positives reach.
    """
    if len(good) < 20 or len(unlabelled) < 20:
        return 0.5
    model = fit(good[::2], unlabelled[::2], 0.5, seed)
    g, u = np.sort(model.logits(good[1::2])), np.sort(model.logits(unlabelled[1::2]))
    cuts = np.quantile(g, np.linspace(0.02, 0.8, 40))
    over_g = 1 - np.searchsorted(g, cuts) / len(g)
    over_u = 1 - np.searchsorted(u, cuts) / len(u)
    noise = np.sqrt(np.maximum(over_u * (1 - over_u), 1e-9) / len(u))
    return float(np.clip(((over_u + noise) / over_g).min(), 0.05, 0.98))


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most_rows: int = MOST_ROWS,
) -> Model:
    """Learn from bounded samples of positives and of unlabelled rows, none held out.

    An id with several labels is good only if all say so; null labels are none. Unlabelled rows
    are drawn from all rows, whether labelled or not, without a look at labels. Without
    positives all scores are about one half.
    """
    known = labels.where(F.col(label).isNotNull()).groupBy(doc_id).agg(F.min(label).alias("y"))
    good = sample_ids(known.where("y = 1"), doc_id, most_rows)
    unlabelled = sample_ids(docs, doc_id, most_rows)
    figures = []
    for ids in (good, unlabelled):
        rows = sampled(docs, ids, doc_id, text).orderBy("doc_id", "text").limit(most_rows)
        texts = [r.text for r in rows.collect()]
        figures.append(text_figures(pa.array(texts, pa.large_string())))
    return fit(*figures, estimate_prior(*figures))


def score_quality(
    docs: DataFrame, model: Model, text: str = "text", out: str = "score"
) -> DataFrame:
    """`docs` with a score from 0 to 1 of each whole text in the column `out`.

    Null and empty texts get the score of a text without words. Rows are scored one by one.
    """
    shared = share(docs.sparkSession, model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(shared.value.scores(batch), pa.float64())

    return docs.withColumn(out, score(F.col(text)))
