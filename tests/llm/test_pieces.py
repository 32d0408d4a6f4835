"""Pieces and token counts against the model's own library."""

import random
import sys

import pytest
import sentencepiece
from public_tokenizers import path
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from weblens.llm.pieces import (
    UNIGRAM,
    PieceCoder,
    decode_pieces,
    encode_pieces,
    read_model,
)
from weblens.llm.token_counts import TokenCounter, count_tokens

MODEL = read_model(path("piece_bpe_32k.model"))
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
PARTS = [*"aabbceehtt  ▁\n\t.,!日本éßﬁ😀\x00", "the", "ing", "    ", " be", "\r\n", "Wörter"]


def texts(count, most, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, most))) for _ in range(count)]


def test_merging_gives_the_ids_of_the_library():
    coder = PieceCoder(MODEL)
    for text in texts(3000, 25, 1):
        ids = LIBRARY.encode(text)
        assert coder.encode([text]) == [ids]
        assert coder.decode(ids) == LIBRARY.decode(ids)


def test_words_are_forgotten_but_not_changed(monkeypatch):
    monkeypatch.setattr("weblens.llm.pieces.MEMO_BYTES", 10_000)
    monkeypatch.setattr("weblens.llm.pieces.MEMO_PAIRS", 5)
    coder = PieceCoder(MODEL)
    sample = texts(200, 30, 2)
    for i in range(0, 200, 10):
        assert coder.encode(sample[i : i + 10]) == LIBRARY.encode(sample[i : i + 10])
    assert len(coder.pairs) <= 6


def unspaced(k):
    return "".join(chr(0x4E00 + (i * (k + 3)) % 5000) for i in range(3000))


@pytest.mark.parametrize("coder", [PieceCoder(MODEL), TokenCounter(MODEL)])
def test_memory_of_words_is_bounded_in_bytes(monkeypatch, coder):
    """Texts without spaces, each a word of its own, and many short words."""
    for module in ("pieces", "token_counts"):
        monkeypatch.setattr(f"weblens.llm.{module}.MEMO_BYTES", 200_000)
    for k in range(20):
        sample = [unspaced(k), " ".join(f"w{i}x{k}" for i in range(400))]
        if isinstance(coder, PieceCoder):
            assert coder.encode(sample) == LIBRARY.encode(sample)
            held = [*coder.words.items(), *coder.older.items()]
        else:
            assert coder.count(sample) == [len(ids) for ids in LIBRARY.encode(sample)]
            held = [(p, b"1234") for p in coder.parts]
        assert sum(sys.getsizeof(w) + sys.getsizeof(ids) for w, ids in held) <= 200_000
    coder.forget()
    assert coder.held == 0


def unigram_model():
    """The same pieces with other scores, as a model that Viterbi decides."""
    model = model_pb2.ModelProto.FromString(MODEL)
    rng = random.Random(3)
    model.trainer_spec.model_type = UNIGRAM
    for piece in model.pieces:
        piece.score = -rng.uniform(3, 12) if piece.type == 1 else piece.score
    return model.SerializeToString()


def test_viterbi_gives_the_ids_of_the_library():
    proto = unigram_model()
    coder = PieceCoder(proto)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto)
    for text in texts(1000, 20, 4):
        [mine], theirs = coder.encode([text]), library.encode(text)
        if mine != theirs:  # two best segmentations: the library adds up in single precision
            sums = [sum(coder.scores_by_id[i] for i in ids) for ids in (mine, theirs)]
            assert sums[0] == pytest.approx(sums[1], abs=1e-3)
            assert coder.decode(mine) == coder.decode(theirs)


def test_frames_with_nulls_repeats_and_other_columns(spark):
    rows = [(1, "a tree", "x"), (1, "a tree", "x"), (None, None, None), (3, "", "y"), (4, " é\n", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(2)
    coded = encode_pieces(docs, MODEL, decoded="back")
    assert coded.columns == ["doc_id", "text", "ids", "piece_ids", "back"]
    for row in coded.collect():
        assert row.piece_ids == LIBRARY.encode(row.text or "")
        assert row.back == (row.text or "")
    again = decode_pieces(encode_pieces(docs, MODEL, out="ids"), MODEL, "ids")
    assert all(r.decoded == (r.text or "") for r in again.collect())
    assert encode_pieces(docs.limit(0), MODEL).count() == 0


def test_a_very_long_text(spark):
    text = " ".join(texts(1, 60_000, 5)) + "x" * 5000
    row = encode_pieces(spark.createDataFrame([(text,)], "text string"), MODEL, decoded="d").first()
    assert row.piece_ids == LIBRARY.encode(text)


@pytest.mark.parametrize("chunk,overlap", [(64, 8), (37, 3), (1 << 20, 512)])
def test_counts_are_those_of_the_library(spark, chunk, overlap):
    parts = ["the", "a", " ", "😀", "é", " b", ".\n"]
    rng = random.Random(6)
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 600)))) for i in range(25)]
    # No stable boundary at all, repeated rows, one id with two texts, nulls.
    rows += [(90, "x" * 700), (90, "x" * 700), (90, "y"), (91, " " * 500), (None, None), (92, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = count_tokens(docs, MODEL, limit=50, chunk_chars=chunk, overlap_chars=overlap)
    want = []
    for i, text in rows:
        n = len(LIBRARY.encode(text or ""))
        want.append((i, len((text or "").encode()), n, n > 50))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_boundaries_are_proven():
    counter = TokenCounter(MODEL)
    assert counter.stable("e", " ") and not counter.stable("t", "h")
    assert not counter.stable(" ", " ")


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert count_tokens(docs, MODEL).count() == 0
    assert count_tokens(docs.withColumn("n_tokens", F.lit("x")), MODEL).count() == 0
