"""Held-out accuracy of the classifiers, and their rules for odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weblens.llm import hashed_words as words
from weblens.llm import quality, toxicity
from weblens.llm.common import release_memory
from weblens.llm.folds import held_out
from weblens.llm.queries import op8_quality, op9_toxicity

SF_DIR = "/root/testdata/sf0.1"


def test_hashes_are_of_words_not_of_places():
    raw, rows = words.text_bytes(pa.array(["One two", None, "two  ONE ", "", "éa é"]))
    found = words.Words(raw, rows, words.BLANK)
    h = found.hashes()
    assert list(np.searchsorted(found.begins, rows)) == [0, 2, 2, 4, 4, 6]
    assert h[0] == h[3] and h[1] == h[2] and len(set(h.tolist())) == 4
    assert found.hashes(1)[1] == found.hashes(1)[2]


def test_words_longer_than_a_part(monkeypatch):
    monkeypatch.setattr(words, "PART_BYTES", 8)
    texts = pa.array(["a" * 30 + " b", "cc dd ee ff gg hh", ""])
    got, ends = words.word_hashes(texts, words.BLANK)
    assert list(ends) == [0, 2, 8, 8] and len(set(got.tolist())) == 8


# The small table has 330 toxic rows to learn from, in four languages.
@pytest.mark.parametrize(
    "query,label,least", [(op8_quality, "quality", 0.98), (op9_toxicity, "toxic", 0.95)]
)
def test_held_out_accuracy(spark, query, label, least):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = query(spark, SF_DIR).join(labels, "doc_id").where("held_out")
    right = scored.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]
    assert right >= least


def test_toxic_rows_are_found_in_each_language(spark):
    """Some labels are wrong in the table: 114 of 120 toxic rows hold any sign of it."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic IS NOT NULL")
    lang = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    scored = op9_toxicity(spark, SF_DIR).where("held_out").join(labels, "doc_id")
    counts = scored.join(lang, "doc_id").groupBy("lang").agg(
        F.sum("toxic").alias("toxic"),
        F.sum("predicted").alias("flagged"),
        F.sum(F.col("toxic") * F.col("predicted")).alias("right"),
    )
    rows = {r.lang: r for r in counts.collect()}
    toxic, flagged, right = (sum(r[n] for r in rows.values()) for n in ("toxic", "flagged", "right"))
    assert right >= 0.87 * toxic and right >= 0.9 * flagged
    assert rows["en"]["right"] >= 0.9 * rows["en"]["toxic"]
    assert all(r["right"] >= 0.5 * r["toxic"] for r in rows.values())


def plain_features(text):
    """Features of each word of a text, by plain loops."""
    features, ends, _ = toxicity.word_features(pa.array([text]))
    assert ends[-1] == len(features)
    return features.tolist()


def plain_log_odds(model, features):
    """The forward pass of one text by plain loops."""
    nothing = [0.0] * toxicity.SIZE
    vectors = [
        [sum(float(model.embeddings[f][d]) for f in word) for d in range(toxicity.SIZE)]
        for word in features
    ] + [nothing] * max(toxicity.WIDTHS)
    total, at = model.bias, 0
    for k, width in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            # Windows run on into the empty words behind a text.
            padded = vectors + [nothing] * width
            best = max(
                float(model.shifts[k][f])
                + sum(padded[i + j][d] * float(model.filters[k][j][d][f]) for j in range(width) for d in range(toxicity.SIZE))
                for i in range(len(vectors))
            )
            total += max(best, 0.0) * float(model.output[at])
            at += 1
    return total


def test_scores_are_those_of_plain_loops(spark):
    kinds = ["bad {} idiot words", "good {} words and the", "der {} ist nicht", "an idiot {}", "los {} y una"]
    texts = [kinds[i % 5].format(f"w{i} v{i} u{i}") for i in range(200)]
    model = toxicity.train(texts, np.array([1, 0, 0, 1, 0] * 40))
    texts = [*texts[:8], "", None, "idiot", "der idiot ist nicht mit " * 9]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    for i, text in enumerate(texts):
        features = plain_features(text)
        odds = [plain_log_odds(m, features) for m in model.members]
        raw = 1 / (1 + np.exp(-sum(odds) / len(odds)))
        words = (text or "").split()
        known = [sum(w in own for w in words) for own in toxicity.FUNCTION_WORDS.values()]
        t = model.thresholds[known.index(max(known))]
        want = 0.3 * raw / t if raw < t else 0.3 + 0.7 * (raw - t) / (1 - t)
        assert abs(got[i] - want) < 1e-4, text


def test_few_rows_of_a_language_are_drawn_to_all():
    y = np.array([1] * 40 + [0] * 160 + [1, 0])
    raw = np.array([0.8] * 40 + [0.2] * 160 + [0.1, 0.6])
    language = np.array([0] * 200 + [3, 3])
    thresholds = toxicity._calibrate(raw, y, language)
    assert ((thresholds > 0.2) & (thresholds <= 0.8)).all()


def test_odd_rows(spark):
    texts = ["a fine text of words", None, "", "idiot " * 20000, "a fine text of words"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(0, 1, 0), (0, None, None), (None, 1, 1), (3, 0, 1)], "doc_id long, quality int, toxic int")
    for module, train, score in (
        (quality, quality.train_quality, quality.score_quality),
        (toxicity, toxicity.train_toxicity, toxicity.score_toxicity),
    ):
        for known in (labels, labels.limit(0)):
            rows = score(docs, train(docs, known)).orderBy("doc_id").collect()
            found = [r.score for r in rows]
            assert all(0 <= s <= 1 for s in found) and found[0] == found[4] and found[1] == found[2]
        assert score(docs.limit(0), train(docs.limit(0), labels.limit(0))).count() == 0


def test_held_out_is_by_the_checksum_of_the_id(spark):
    import zlib

    ids = spark.range(200).select(F.col("id"), held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in ids)


def test_prior_and_risk():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0, 1, (3000, 4)), rng.normal(3, 1, (3000, 4))
    mixed = np.concatenate([good[:1000], bad[:500]])
    prior = quality.estimate_prior(good[1000:], mixed)
    assert abs(prior - 2 / 3) < 0.08
    model = quality.fit(good[1000:], mixed, prior)
    assert (model.logits(good) > 0).mean() > 0.97 and (model.logits(bad[500:]) < 0).mean() > 0.97


def test_filters_meet_the_same_words_in_any_slice(monkeypatch):
    kinds = ["bad {} idiot words", "good {} words", "{} only", "an idiot {}", "nice day {}"]
    texts = [kinds[i % 5].format(f"w{i} v{i} u{i}") for i in range(200)]
    model = toxicity.train(texts, np.array([1, 0, 0, 1, 0] * 40))
    texts = ["bad idiot words", "good words only", "", "an idiot", "nice day"] * 20
    whole = model.scores(pa.array(texts))
    monkeypatch.setattr(toxicity, "SLICE", 7)
    assert np.allclose(whole, model.scores(pa.array(texts)), atol=1e-6)
    assert (whole[[0, 3]] > 0.3).all() and (whole[[1, 2, 4]] < 0.3).all()


def test_near_copies_are_alike_and_of_one_label():
    def rows(*texts):
        return [np.array(t, np.int32).reshape(-1, 1) for t in texts]

    # All share their three smallest words.
    base = [1, 2, 3, *range(100, 140)]
    unlike, near, part = [1, 2, 3, *range(200, 240)], [*base, 300, 301], base[:20]
    texts = rows(base, unlike, near, part, base, unlike, [], [])
    assert toxicity._different(texts, np.array([1, 1, 1, 1, 0, 1, 0, 1])) == [0, 1, 3, 4, 6, 7]


def test_quality_learns_where_every_row_is_labelled(spark):
    rng = np.random.default_rng(3)
    words = [f"w{k}ord" for k in range(300)]
    rows = []
    for i in range(600):
        good = " ".join(rng.choice(words, 40)) + "."
        rows.append((i, good if i % 2 else "!! $$ 12 " * 30, i % 2))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    for label in ("quality", "IF(quality = 1, 1, NULL) AS quality"):
        model = quality.train_quality(table, table.selectExpr("doc_id", label))
        scored = quality.score_quality(table, model).collect()
        right = [(r.score >= quality.THRESHOLD) == (r.quality == 1) for r in scored]
        assert np.mean(right) > 0.95


def numbered_rows(spark, n):
    """Rows of which one in ten is toxic, told by one word; no two are near copies."""
    words = " ".join(f"concat('w', (id * {p}) % 9973)" for p in (7, 11, 13, 17, 19, 23)).split(" concat")
    text = "concat_ws(' ', if(id % 10 = 0, 'idiot', 'fine'), " + ", concat".join(words) + ")"
    docs = spark.range(n).selectExpr("id AS doc_id", f"{text} AS text")
    return docs, spark.range(n).selectExpr("id AS doc_id", "int(id % 10 = 0) AS toxic")


def test_all_labelled_rows_are_learnt_from(spark):
    """However many, however long; near copies once, and held out rows never."""
    docs, labels = numbered_rows(spark, 7000)
    extra = [(7001, "long " * 15_000), (7003, "same words here"), (7005, "same words here")]
    extra += [(7007, "one two three four five six seven eight nine ten"), (7009, None)]
    extra += [(7011, "one two three four five six seven eight nine ten ten")]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    labels = labels.unionByName(spark.createDataFrame([(r[0], 0) for r in extra], "doc_id long, toxic int"))
    used = docs.where(~held_out("doc_id") & F.col("text").isNotNull())
    rows = toxicity.different_rows(docs, labels, "doc_id", "text", "toxic").collect()
    texts = [r.text for r in rows]
    assert len(set(texts)) == len(texts) and set(texts) <= {r.text for r in used.collect()}
    clean, toxic = (sum(r.y == y for r in rows) for y in (0, 1))
    assert clean > 4000 and clean + toxic >= used.where("doc_id < 7000").count()
    kept = [r.text for r in used.where("doc_id > 7000").dropDuplicates(["text"]).collect()]
    ten = [t for t in kept if t.startswith("one two")]
    assert all(t in texts for t in kept if t not in ten) and (not ten or sum(t in texts for t in ten) == 1)


def test_means_of_shards(spark, monkeypatch):
    """Shards are fitted apart; the mean tells the classes as one classifier does."""
    docs, labels = numbered_rows(spark, 1200)
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 12_000)
    model = toxicity.train_toxicity(docs, labels)
    scored = toxicity.score_toxicity(docs, model).join(labels, "doc_id").collect()
    right = [(r.score >= toxicity.THRESHOLD) == (r.toxic == 1) for r in scored]
    assert np.mean(right) > 0.98


def test_blocks_and_long_rows(monkeypatch):
    rng = np.random.default_rng(3)
    model = toxicity._start(rng.integers(0, 30, (2, toxicity.BUCKETS)), np.array([50, 50]), rng)
    other = toxicity._start(np.zeros((2, toxicity.BUCKETS)), np.zeros(2), rng)
    for k, block in enumerate(model.blocks()):
        other.put_block(k, block.astype(np.float32))
    assert (other.embeddings == model.embeddings).all() and (other.filters[2] == model.filters[2]).all()
    x = rng.normal(size=(60, toxicity.SIZE)).astype(np.float32)
    begins, ends = np.array([0, 20, 25]), np.array([18, 22, 57])
    whole = toxicity._peaks(model, x, begins, ends)
    monkeypatch.setattr(toxicity, "SLICE", 4)
    parts = toxicity._peaks(model, x, begins, ends)
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1])
    rows = [np.zeros((n, 4), np.int32) for n in (3, 1, 9, 2, 0)]
    cut = toxicity._by_words(rows, np.arange(5))
    assert np.concatenate(cut).tolist() == list(range(5)) and len(cut) > 1


def test_shards_hold_features_not_text():
    """While a shard is gathered, the texts of its earlier batches are given up."""
    held = []

    def batches():
        for k in range(12):
            texts = [f"word{k} and {i} more " * 50 for i in range(1000)]
            columns = [pa.array(texts), pa.array([1] * 1000, pa.int32()), pa.array([k % 3] * 1000, pa.int32())]
            del texts
            batch = pa.RecordBatch.from_arrays(columns, schema=toxicity.LEARNT)
            size = batch.nbytes
            del columns
            yield batch
            del batch
            held.append((pa.total_allocated_bytes() - before) / size)

    class Start:
        value = []

    before = pa.total_allocated_bytes()
    assert list(toxicity._fit_shards(Start)(batches())) == []
    assert len(held) == 12 and max(held) < 3


def test_shards_have_all_rows(monkeypatch):
    """Several runs hold each row once, in order, with the features that the whole column has."""
    texts = [f"one {'two ' * (i % 7)}three{i}" if i % 11 else "" for i in range(300)]
    y, fold = np.arange(300) % 2, np.arange(300) % 3
    table = pa.table([pa.array(texts), pa.array(y, pa.int32()), pa.array(fold, pa.int32())], schema=toxicity.LEARNT)
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 2_000)
    shards = list(toxicity._shards(iter(table.to_batches(max_chunksize=40))))
    assert len(shards) > 2
    features, ends, _ = toxicity.word_features(pa.array(texts))
    rows = [r for shard in shards for r in shard[0]]
    assert [r.tolist() for r in rows] == [features[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert np.concatenate([s[1] for s in shards]).tolist() == y.tolist()
    assert np.concatenate([s[2] for s in shards]).tolist() == fold.tolist()


def test_freed_memory_goes_back():
    """What lies free below a value still in use goes back to the system."""

    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096

    blocks = [np.ones(12_000) for _ in range(2_000)]  # each too small to be mapped by itself
    last = np.ones(12_000)
    full = resident()
    del blocks
    release_memory()
    assert full - resident() > 150_000_000 and last.sum() == 12_000
