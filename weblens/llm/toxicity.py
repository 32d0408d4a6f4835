"""A convolutional text classifier for toxicity, trained in numpy.

A word's vector is the sum of hashed embeddings of the word and of its first bytes, so that
inflected and unseen forms share what was learnt about their beginnings. Filters of several
widths run over a text's words; each filter's largest response over the whole text goes into
a logistic output. Embeddings, filters and output are trained together (Adam); embeddings
start from the log-odds of each feature in all rows learnt from.

The rows to learn from are cut into `FOLDS` parts by their words, and a classifier is trained without each of them; a score
is the mean of their log-odds. Thresholds are calibrated by language on what each classifier says
of the part it has not seen, so all rows are learnt from and all calibrate. A language with few
rows is drawn towards the threshold of all. The language is told from the text's function words,
never from a column, and a score is bent so that its language's threshold becomes `THRESHOLD`.
"""

from __future__ import annotations

import copy
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from weblens.llm.common import batch_of, release_memory, share
from weblens.llm.folds import held_out
from weblens.llm.hashed_words import NO_WORD, Words, parts, row_slices, text_bytes, word_hashes
from weblens.shared import broadcast_within_limit, cut_lineage, ship

THRESHOLD = 0.3
# Text that one set of classifiers is fitted on at a time; larger tables have several such shards,
# and the classifiers are the means of theirs.
SHARD_BYTES = 40 << 20
BLOCK = 1024  # buckets whose embeddings are averaged together
MOST_COMPARED = 64  # rows of a key that one is compared with; more may be near copies kept twice
SEED = 7
ALIKE = 0.8  # of the words of two rows: near copies, of which one is learnt from
BUCKETS = 1 << 16
FEATURE = np.uint16  # holds any bucket's number
BEGINNINGS = (4, 5, 6)  # bytes
SIZE, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
STEPS, BATCH, RATE, DECAY = 500, 32, 0.01, 0.1
# Rows a feature must be in to get an embedding of its own: one in 500, within these.
LEAST_SEEN = (3, 8)
PRIOR_ROWS = 10
FOLDS = 3
SHARED_ROWS = 10  # toxic rows that all languages together stand for in each one's threshold
SLICE = 100_000  # words worked on at a time

# Function words that tell the languages apart.
FUNCTION_WORDS = {
    "en": "the of and to in is that for with as".split(),
    "fr": "le les et des un une est dans qui aux".split(),
    "de": "der die und das den mit ist von im nicht".split(),
    "es": "el los las y una del con por su al".split(),
}


def _language_hashes() -> list[np.ndarray]:
    found = []
    for words in FUNCTION_WORDS.values():
        raw = np.frombuffer(" ".join(words).encode(), np.uint8)
        found.append(Words(raw, np.zeros(1, np.int64), NO_WORD).hashes())
    return found


def word_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of all words (a row each), word ends of the rows, and their languages."""
    raw, rows = text_bytes(column)
    languages = _language_hashes()
    counts = np.zeros((len(rows) - 1, len(languages)), np.int64)
    features, begins = [np.zeros((0, 1 + len(BEGINNINGS)), np.int32)], [np.zeros(0, np.int64)]
    for low, high in parts(raw, NO_WORD):
        words = Words(raw[low:high], rows - low, NO_WORD)
        whole = words.hashes()
        columns = [whole]
        for k in BEGINNINGS:
            # Shorter words count as the whole word only; the place keeps beginnings apart.
            start = words.hashes(k) + np.uint64(k)
            columns.append(np.where(words.ends - words.begins >= k, start, whole))
        features.append((np.stack(columns, 1) % np.uint64(BUCKETS)).astype(np.int32))
        begins.append(words.begins + low)
        row = np.searchsorted(rows, begins[-1], "right") - 1
        for k, known in enumerate(languages):
            counts[:, k] += np.bincount(row[np.isin(whole, known)], minlength=len(rows) - 1)
    ends = np.searchsorted(np.concatenate(begins), rows)
    return np.concatenate(features), ends, counts.argmax(1)


@dataclass
class Model:
    embeddings: np.ndarray  # buckets x size
    filters: list[np.ndarray]  # per width: width x size x filters
    shifts: list[np.ndarray]  # per width: filters
    output: np.ndarray
    bias: float

    def blocks(self) -> list[np.ndarray]:
        """All parameters as flat runs: of the embeddings by `BLOCK` buckets, then the others."""
        cut = [self.embeddings[i : i + BLOCK].ravel() for i in range(0, BUCKETS, BLOCK)]
        small = [*self.filters, *self.shifts, self.output, np.array([self.bias])]
        return [*cut, np.concatenate([p.ravel() for p in small])]

    def put_block(self, block: int, value: np.ndarray) -> None:
        if block * BLOCK < BUCKETS:
            self.embeddings[block * BLOCK : (block + 1) * BLOCK] = value.reshape(-1, SIZE)
            return
        at = 0
        for p in (*self.filters, *self.shifts, self.output):
            p[...] = value[at : at + p.size].reshape(p.shape)
            at += p.size
        self.bias = float(value[at])

    def pooled(self, features: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Largest response of every filter over each row's words."""
        n = len(ends) - 1
        widest = max(WIDTHS)
        # Rows are told apart by padding: `widest` empty words end each of them.
        out = np.full((n, len(WIDTHS) * FILTERS), -np.inf, np.float32)
        at = np.arange(len(features)) + widest * np.repeat(np.arange(n), np.diff(ends))
        total = len(features) + widest * n
        row_begins = ends[:-1] + widest * np.arange(n)
        # Windows count from each word and from the first empty one; later ones reach the next row.
        behind = (row_begins + np.diff(ends))[:, None] + np.arange(1, widest)
        behind = behind.ravel()
        for low in range(0, total, SLICE):
            high = min(low + SLICE, total)
            last = min(high + widest - 1, total)
            inside = slice(*np.searchsorted(at, (low, last)))
            x = np.zeros((high - low + widest - 1, SIZE), np.float32)
            x[at[inside] - low] = self.embeddings[features[inside]].sum(1)
            z = np.concatenate(
                [self._responses(x, k, high - low) for k in range(len(WIDTHS))], 1
            )
            z[behind[slice(*np.searchsorted(behind, (low, high)))] - low] = -np.inf
            first = np.searchsorted(row_begins, low, "right") - 1
            until = np.searchsorted(row_begins, high)
            cuts = np.maximum(row_begins[first:until] - low, 0)
            best = np.maximum.reduceat(z, cuts, axis=0)
            out[first:until] = np.maximum(out[first:until], best)
        return out

    def _responses(self, x: np.ndarray, k: int, n: int) -> np.ndarray:
        z = self.shifts[k] + x[:n] @ self.filters[k][0]
        for j in range(1, WIDTHS[k]):
            z += x[j : j + n] @ self.filters[k][j]
        return z

    def log_odds(self, features: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(ends) == 1:
            return np.zeros(0)
        hidden = np.maximum(self.pooled(features, ends), 0)
        return (hidden @ self.output + self.bias).astype(np.float64)


@dataclass
class Committee:
    """The classifiers of all folds, and their thresholds as probabilities, one per language."""

    members: list[Model]
    thresholds: np.ndarray

    def scores(self, column: pa.Array) -> np.ndarray:
        found = [self._scores(part) for part in row_slices(column)]
        return np.concatenate([np.zeros(0), *found])

    def _scores(self, column: pa.Array) -> np.ndarray:
        features, ends, language = word_features(column)
        raw = _probability(np.mean([m.log_odds(features, ends) for m in self.members], 0))
        t = self.thresholds[language]
        bent = np.where(
            raw < t, THRESHOLD * raw / t, THRESHOLD + (1 - THRESHOLD) * (raw - t) / (1 - t)
        )
        return np.clip(bent, 0.0, 1.0)


def _probability(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(log_odds, -500, 500)))


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Committee:
    """Fit a classifier without each fold, and calibrate on the folds left out."""
    rng = np.random.default_rng(seed)
    features, ends, language = word_features(pa.array(texts, pa.large_string()))
    rows = [features[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    order = rng.permutation(_different(rows, labels)).astype(np.int64)
    unseen = np.zeros(len(order))  # log-odds of each row by the classifier that has not seen it
    members, fitted = [], True
    for fold in range(FOLDS):
        out = np.arange(len(order)) % FOLDS == fold
        learn = order[~out]
        number = np.bincount(labels[learn], minlength=2)
        model = _start(_seen(rows, labels, learn), number, rng)
        both = len(learn) > 0 and all((labels[learn] == y).any() for y in (0, 1))
        if both:
            _fit(model, rows, labels.astype(np.float32), learn, rng)
        fitted &= both
        if out.any():
            left = [rows[i] for i in order[out]]
            ends = np.cumsum([0, *map(len, left)])
            unseen[out] = model.log_odds(np.concatenate(left), ends)
        members.append(model)
    thresholds = np.full(len(FUNCTION_WORDS), 0.5)
    if fitted:
        thresholds = _calibrate(_probability(unseen), labels[order], language[order])
    return Committee(members, thresholds)


def _different(rows: list[np.ndarray], labels: np.ndarray) -> list[int]:
    """One of each group of near copies: of rows of one label that share `ALIKE` of their words.

    Words that only copies of one text have would look like signs of its label. Rows whose
    three smallest words are the same are compared.
    """
    kept: dict[tuple[int, bytes], list[np.ndarray]] = {}
    found, inside = [], np.zeros(BUCKETS, bool)
    for i, words in enumerate(rows):
        own = np.unique(words[:, 0])
        others = kept.setdefault((int(labels[i]), own[:3].tobytes()), [])
        inside[own] = True
        if not any(_alike(own, inside, other) for other in others):
            others.append(own)
            found.append(i)
        inside[own] = False
    return found


def _alike(own: np.ndarray, inside: np.ndarray, other: np.ndarray) -> bool:
    """Whether `ALIKE` of the words of either row are in both; `inside` tells those of `own`."""
    few, many = sorted((len(own), len(other)))
    if few < ALIKE * many:
        return False
    both = np.count_nonzero(inside[other])
    return bool(both >= ALIKE * (few + many - both))


def _seen(rows, labels, learn) -> np.ndarray:
    """In how many rows of each label a feature is."""
    seen = np.zeros((2, BUCKETS))
    for i in learn:
        seen[labels[i], np.unique(rows[i])] += 1
    return seen


def _start(seen: np.ndarray, number: np.ndarray, rng) -> Model:
    """A classifier to train, out of the rows of each label, with a feature and in all."""
    # Log-odds, drawn towards those of all rows as if each feature had `PRIOR_ROWS` more rows.
    base = np.clip(number[1] / number.sum() if number.sum() else 0.5, 0.01, 0.99)
    rate = (seen[1] + PRIOR_ROWS * base) / (seen.sum(0) + PRIOR_ROWS)
    odds = np.log(rate / (1 - rate)) - np.log(base / (1 - base))
    known = seen.sum(0) >= np.clip(number.sum() // 500, *LEAST_SEEN)
    embeddings = rng.normal(0, 0.05, (BUCKETS, SIZE)).astype(np.float32)
    embeddings[:, 0] = np.clip(odds, -3, 3) / 2
    embeddings *= known[:, None]
    filters = []
    for width in WIDTHS:
        w = rng.normal(0, 0.1, (width, SIZE, FILTERS)).astype(np.float32)
        w[:, 0, :] += 1.0 / width
        filters.append(w)
    shifts = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    output = np.full(len(WIDTHS) * FILTERS, 0.1, np.float32)
    return Model(embeddings, filters, shifts, output, -2.0)


def _by_words(rows, batch: np.ndarray) -> list[np.ndarray]:
    """A batch in parts of about `SLICE` words; a longer row is a part of its own."""
    ends = np.cumsum([len(rows[i]) for i in batch])
    parts = (ends - 1) // SLICE
    return np.split(batch, np.flatnonzero(np.diff(parts)) + 1)


def _peaks(model: Model, x: np.ndarray, begins, ends) -> tuple[np.ndarray, np.ndarray]:
    """Where each row has each filter's largest response, the first of equal ones, and that."""
    widest, filters = max(WIDTHS), len(WIDTHS) * FILTERS
    best = np.zeros((len(begins), filters), np.int64)
    peak = np.full((len(begins), filters), -np.inf, np.float32)
    for low in range(0, int(ends[-1]), 2 * SLICE):
        high = min(low + 2 * SLICE, int(ends[-1]))
        part = x[low : high + widest]
        z = [model._responses(part, k, high - low) for k in range(len(WIDTHS))]
        z = np.concatenate(z, 1)
        for i in range(np.searchsorted(ends, low, "right"), np.searchsorted(begins, high)):
            a, b = max(begins[i], low), min(ends[i], high)
            at = z[a - low : b - low].argmax(0)
            value = z[a - low + at, np.arange(filters)]
            more = value > peak[i]
            best[i, more], peak[i, more] = (a + at)[more], value[more]
    return best, peak


def _fit(model: Model, rows, labels, learn, rng) -> None:
    """Minimise the logistic loss. Only the word at each filter's maximum gets a gradient."""
    trained = [*model.filters, *model.shifts, model.output, np.zeros(1, np.float32)]
    trained[-1][0] = model.bias
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in [*trained, model.embeddings]]
    weight = np.where(labels == 1, 0.5 / labels[learn].mean(), 0.5 / (1 - labels[learn].mean()))
    widest, step = max(WIDTHS), 0
    frozen = ~model.embeddings.any(1)
    parts_of = max(1, len(learn) // BATCH)
    for _ in range(max(1, STEPS // parts_of)):
        cuts = np.array_split(rng.permutation(learn), parts_of)
        for batch in (part for cut in cuts for part in _by_words(rows, cut)):
            gradients = [np.zeros_like(p) for p in trained]
            e_rows, e_values = [], []
            lengths = np.array([len(rows[i]) for i in batch])
            words = np.concatenate([rows[i] for i in batch])
            # As in `pooled`, `widest` empty words end each row.
            begins = np.cumsum(lengths + widest) - lengths - widest
            at = np.arange(len(words)) + np.repeat(begins - np.cumsum(lengths) + lengths, lengths)
            n = len(words) + widest * len(batch)
            word_at = np.full(n + widest, -1)
            word_at[at] = np.arange(len(words))
            x = np.zeros((n + widest, SIZE), np.float32)
            x[at] = sum(model.embeddings[column] for column in words.T)
            best, peak = _peaks(model, x, begins, begins + lengths + 1)
            hidden = np.maximum(peak, 0)
            p = 1 / (1 + np.exp(-(hidden @ model.output + trained[-1][0])))
            d = ((p - labels[batch]) * weight[batch] / len(batch)).astype(np.float32)
            gradients[-2] += d @ hidden
            gradients[-1] += d.sum()
            back = d[:, None] * model.output * (hidden > 0)
            for k, width in enumerate(WIDTHS):
                part = slice(k * FILTERS, (k + 1) * FILTERS)
                gradients[len(WIDTHS) + k] += back[:, part].sum(0)
                for j in range(width):
                    places = best[:, part] + j
                    gradients[k][j] += np.einsum("rfs,rf->sf", x[places], back[:, part])
                    inside = word_at[places] >= 0
                    values = (model.filters[k][j].T * back[:, part, None])[inside]
                    touched = words[word_at[places[inside]]]
                    e_rows.append(touched.ravel())
                    e_values.append(np.repeat(values, touched.shape[1], 0))
            step += 1
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for value, g, (m, v) in zip(trained, gradients, state, strict=False):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                value -= rate * (m / (np.sqrt(v) + 1e-8) + DECAY * value)
            at, inverse = np.unique(np.concatenate(e_rows), return_inverse=True)
            g = np.zeros((len(at), SIZE), np.float32)
            np.add.at(g, inverse, np.concatenate(e_values))
            g[frozen[at]] = 0
            m, v = state[-1]
            m[at] += 0.1 * (g - m[at])
            v[at] += 0.001 * (g * g - v[at])
            move = m[at] / (np.sqrt(v[at]) + 1e-6) + DECAY * model.embeddings[at]
            model.embeddings[at] -= 0.5 * rate * move
            model.bias = float(trained[-1][0])


GRID = _probability(np.linspace(-6, 8, 85))


def _calibrate(raw: np.ndarray, y: np.ndarray, language: np.ndarray) -> np.ndarray:
    """Thresholds from the probabilities, labels and languages of rows not seen."""
    counts = np.zeros((len(FUNCTION_WORDS), 2, len(GRID) + 1))
    np.add.at(counts, (language, y, np.searchsorted(GRID, raw, "right")), 1)
    return _thresholds(counts)


def _thresholds(counts: np.ndarray) -> np.ndarray:
    """Per language, a middle one of the thresholds with the best F1 on rows not seen.

    Takes rows by language, label and how much of `GRID` they reach. The rows of all languages
    count in each, together as much as `SHARED_ROWS` toxic ones.
    """
    over = counts[:, :, ::-1].cumsum(2)[:, :, ::-1]  # at 0 all rows, then those over each step
    share = SHARED_ROWS / over[:, 1, 0].sum()
    thresholds = []
    for k in range(len(FUNCTION_WORDS)):
        weighed = over[k] + share * over.sum(0)
        f1 = 2 * weighed[1, 1:] / (weighed[1, 0] + weighed[:, 1:].sum(0))
        thresholds.append(np.quantile(GRID[f1 >= f1.max() - 1e-9], 0.35))
    return np.array(thresholds)


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Committee:
    """Learn from all labelled rows that are not held out, near copies once.

    An id with several labels is toxic if one says so; null labels are none. Without labels
    of both kinds all scores are alike and low.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = different_rows(docs, labels, doc_id, text, label)
    of_fold = F.expr("count(*) AS n"), F.sum(F.octet_length("text")).alias("size")
    found = rows.groupBy("fold", "y").agg(*of_fold).collect()
    number = np.zeros((FOLDS, 2))
    for r in found:
        number[r.fold, r.y] += r.n
    seen = np.zeros((FOLDS, 2, BUCKETS))
    counts = rows.mapInArrow(_count_features, _schema(COUNTED)).groupBy("fold", "y", "feature")
    for r in counts.agg(F.sum("n").alias("n")).toLocalIterator():
        seen[r.fold, r.y, r.feature] = r.n
    members = []
    for fold in range(FOLDS):
        rng = np.random.default_rng(SEED + fold)
        members.append(_start(seen.sum(0) - seen[fold], number.sum(0) - number[fold], rng))
    shards = max(1, -(-sum(r.size for r in found) // SHARD_BYTES))
    learnt = rows.coalesce(shards).mapInArrow(_fit_shards(share(spark, members)), _schema(BLOCKS))
    means = learnt.groupBy("fold", "block").applyInArrow(_mean_block, _schema(BLOCKS))
    fitted = set()
    for r in means.toLocalIterator():
        members[r.fold].put_block(r.block, np.frombuffer(r.value, np.float32))
        fitted.add(r.fold)
    thresholds = np.full(len(FUNCTION_WORDS), 0.5)
    if len(fitted) == FOLDS:
        told = rows.mapInArrow(_count_unseen(share(spark, members)), _schema(TOLD))
        counts = np.zeros((len(FUNCTION_WORDS), 2, len(GRID) + 1))
        for r in told.groupBy("language", "y", "above").agg(F.sum("n").alias("n")).collect():
            counts[r.language, r.y, r.above] = r.n
        thresholds = _thresholds(counts)
    return Committee(members, thresholds)


def different_rows(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str
) -> DataFrame:
    """`(text, y, fold)` of the rows to learn from, written; near copies are of one fold."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id))
    known = known.groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    known = broadcast_within_limit(cut_lineage(known.where("y IN (0, 1)")))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    texts = texts.where(F.col("text").isNotNull()).join(known, "doc_id")

    @F.arrow_udf("binary")
    def smallest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([own[:3].tobytes() for own in _word_sets(batch)], pa.binary())
            release_memory()

    keyed = texts.select("text", "y", smallest("text").alias("key"))
    sorted_rows = keyed.repartition("y", "key").sortWithinPartitions("y", "key", "text")
    return cut_lineage(sorted_rows.mapInArrow(_leave_out_copies, _schema(LEARNT)))


def _schema(fields: pa.Schema) -> T.StructType:
    return from_arrow_schema(fields)


LEARNT = pa.schema([("text", pa.string()), ("y", pa.int32()), ("fold", pa.int32())])
COUNTED = pa.schema([("fold", pa.int32()), ("y", pa.int32()), ("feature", pa.int32()), ("n", pa.int64())])
TOLD = pa.schema([("language", pa.int32()), ("y", pa.int32()), ("above", pa.int32()), ("n", pa.int64())])
BLOCKS = pa.schema(
    [("fold", pa.int32()), ("block", pa.int32()), ("n", pa.int64()), ("value", pa.binary())]
)


def _word_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The different features of each row's whole words."""
    for part in row_slices(column):
        hashes, ends = word_hashes(part, NO_WORD)
        features = (hashes % np.uint64(BUCKETS)).astype(np.int32)
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            yield np.unique(features[a:b])


def _leave_out_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by label, key and text, without near copies of an earlier one of their key."""
    place, previous, others = None, None, []
    inside = np.zeros(BUCKETS, bool)
    for batch in batches:
        kept = []
        for text, y, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (y, key) != place:
                # Most keys have one row: the words of a first row are looked at with a second one.
                place, others = (y, key), [text]
                kept.append((text, y, zlib.crc32(key) % FOLDS))
            elif text != previous:
                others = [next(_word_sets(pa.array([o]))) if isinstance(o, str) else o for o in others]
                own = next(_word_sets(pa.array([text])))
                inside[own] = True
                if not any(_alike(own, inside, other) for other in others[-MOST_COMPARED:]):
                    others.append(own)
                    kept.append((text, y, zlib.crc32(key) % FOLDS))
                inside[own] = False
            previous = text
        yield batch_of(kept, LEARNT)
        release_memory()


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros((FOLDS, 2, BUCKETS), np.int64)
    for batch in batches:
        texts, y, fold = batch.columns
        at = 0
        for part in row_slices(texts):
            features, ends, _ = word_features(part)
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                seen[fold[at].as_py(), y[at].as_py(), np.unique(features[a:b])] += 1
                at += 1
        release_memory()
    fold, y, feature = (a.astype(np.int32) for a in np.nonzero(seen))
    yield pa.RecordBatch.from_arrays(
        [pa.array(a) for a in (fold, y, feature, seen[fold, y, feature])], schema=COUNTED
    )


def _shards(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Features, labels and folds of a task's rows, in runs of about `SHARD_BYTES` of text.

    Of the text itself no more than a batch is held.
    """
    rows, labels, folds, size = [], [], [], 0
    for batch in batches:
        for part in row_slices(batch["text"]):
            features, ends, _ = word_features(part)
            features = features.astype(FEATURE)
            rows += [features[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        labels.append(batch["y"].to_numpy().copy())
        folds.append(batch["fold"].to_numpy().copy())
        size += batch.nbytes
        del batch
        release_memory()
        if size >= SHARD_BYTES:
            yield rows, np.concatenate(labels), np.concatenate(folds)
            rows, labels, folds, size = [], [], [], 0
    if size:
        yield rows, np.concatenate(labels), np.concatenate(folds)


def _fit_shards(start):
    """Fit the classifiers on each shard from the same start; their parameters are averaged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, labels, folds in _shards(batches):
            for fold, first in enumerate(start.value):
                learn = np.flatnonzero(folds != fold)
                if not all((labels[learn] == y).any() for y in (0, 1)):
                    continue
                model = copy.deepcopy(first)
                rng = np.random.default_rng(SEED + fold)
                _fit(model, rows, labels.astype(np.float32), learn, rng)
                for block, value in enumerate(model.blocks()):
                    row = (fold, block, len(learn), value.astype(np.float32).tobytes())
                    yield batch_of([row], BLOCKS)
            rows.clear()
            release_memory()

    return run


def _mean_block(shards: pa.Table) -> pa.Table:
    """The mean of one block of parameters over all shards, by their rows."""
    rows = shards["n"].to_numpy()
    total = 0.0
    for n, value in zip(rows, shards["value"], strict=True):
        total = total + n * np.frombuffer(value.as_py(), np.float32).astype(np.float64)
    mean = (total / rows.sum()).astype(np.float32).tobytes()
    row = (shards["fold"][0].as_py(), shards["block"][0].as_py(), int(rows.sum()), mean)
    return pa.Table.from_batches([batch_of([row], BLOCKS)])


def _count_unseen(members):
    """Rows by language, label and how much of `GRID` their probability reaches, by the
    classifier that has not seen them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(FUNCTION_WORDS), 2, len(GRID) + 1), np.int64)
        for batch in batches:
            for k, model in enumerate(members.value):
                part = batch.filter(pc.equal(batch["fold"], k))
                y, at = part["y"].to_numpy(), 0
                for texts in row_slices(part["text"]):
                    features, ends, language = word_features(texts)
                    raw = _probability(model.log_odds(features, ends))
                    own = y[at : at + len(texts)]
                    np.add.at(counts, (language, own, np.searchsorted(GRID, raw, "right")), 1)
                    at += len(texts)
            release_memory()
        where = [a.astype(np.int32) for a in np.nonzero(counts)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a) for a in (*where, counts[tuple(where)])], schema=TOLD
        )

    return run


def score_toxicity(
    docs: DataFrame, model: Committee, text: str = "text", out: str = "score"
) -> DataFrame:
    """`docs` with a score from 0 to 1 of each whole text in the column `out`.

    Null and empty texts get the score of a text without words. Rows are scored one by one.
    """
    shared = share(docs.sparkSession, model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(shared.value.scores(batch), pa.float64())
            release_memory()

    return docs.withColumn(out, score(F.col(text)))
