"""Alignments against the libraries' whole encodings and plain loops over bytes."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from weblens.llm import alignment
from weblens.llm.alignment import CHUNK_DOCS, TokenAligner, align_tokens, document_scores
from weblens.llm.pieces import read_model

JSON = read_model(public_tokenizers.path("byte_bpe_50k.json"))
MODEL = read_model(public_tokenizers.path("piece_bpe_32k.model"))
A = Tokenizer.from_str(JSON.decode())
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
SIGNS = alignment._byte_of_sign()
NAMES = A.get_vocab()
A_BYTES = {i: bytes(SIGNS[c] for c in t) for t, i in NAMES.items() if t != "<|endoftext|>"}


def b_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:-1], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def spans(ids, bytes_of):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(bytes_of(i))))
        at += len(bytes_of(i))
    return out


def brute_text(text):
    """`(a, b, groups, links)` of a text, None without tokens."""
    if not text:
        return None
    a = spans(A.encode(" " + text, add_special_tokens=False).ids, A_BYTES.__getitem__)
    b = spans(B.encode(text), b_bytes)
    whole = (" " + text).encode()
    if b"".join(A_BYTES[i] for i, _, _ in a) != whole or b"".join(b_bytes(i) for i, _, _ in b) != whole:
        return None
    ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, low = [], 0
    for end in ends:
        inside = [",".join(str(i) for i, s, e in side if low <= s and e <= end) for side in (a, b)]
        groups.append("|".join(inside))
        low = end
    links, first = [], 0
    for i, s, e in a:
        while b[first][2] <= s:
            first += 1
        links += [(i, k) for k, t, f in b[first : first + 400] if t < e and s < f]
    return len(a), len(b), groups, links


def brute(rows):
    found = [(i, brute_text(text)) for i, text in rows]
    docs = Counter(p for _, f in found if f for p in set(f[3]))
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        best = sum(docs[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((i, n_a, n_b, len(groups), len(links), best, sum(docs[p] for p in links), digest))
    return out, docs, Counter(p for _, f in found if f for p in f[3])


def key(row):
    return tuple((v is not None, v) for v in row)


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n b\n", "\t\tx", "x  y", "a  b ",
    "▁", "a▁b", "<s> </s>", "<|endoftext|> x<|endoftext|>", "日本語 テキスト", "\x00 \x1f\x1c b", "🙂 é é",
    "it's don't 'll", "x" * 300, "1234567890 3.14", "  a", "a\x85 b", "word " * 4000, "\r\n \r\n",
]


def test_texts_against_whole_encodings():
    rng = random.Random(5)
    signs = ["a", "the", " ", "  ", "\n", "é", "日", " ", "'s", "1", ".", "\t", "🙂", "Ü", "ing"]
    texts = [t or "" for t in ODD] + ["".join(rng.choices(signs, k=rng.randrange(1, 40))) for _ in range(600)]
    aligner = TokenAligner(JSON, MODEL)
    for text, found in zip(texts, aligner.align(texts), strict=True):
        want = brute_text(text)
        if want is None:
            assert found is None, text
            continue
        links, groups, n_a, n_b = found
        assert (n_a, n_b, groups.decode().split(";")) == want[:3], text
        pairs = [divmod(p, aligner.b_size) for p in np.frombuffer(links, np.int64).tolist()]
        assert sorted(pairs) == sorted(want[3]), text


def test_memory_of_stretches_is_bounded(monkeypatch):
    """Unspaced texts, of which each is one stretch, and many short stretches."""
    monkeypatch.setattr(alignment, "MEMO_BYTES", 100_000)
    aligner = TokenAligner(JSON, MODEL)
    for k in range(30):
        aligner.align(["".join(chr(0x4E00 + (i * k) % 5000) for i in range(2000))])
        aligner.align([" ".join(f"w{i}x{k}" for i in range(500))])
        for held in (aligner.new, aligner.old):
            assert sum(400 + 4 * len(s) + len(e[0]) + len(e[1]) for s, e in held.items()) <= 50_000 + 2_000


def test_new_stretches_are_encoded_together():
    """A batch's new words are one text for A, and those known are not encoded again."""
    aligner = TokenAligner(JSON, MODEL)
    given, tokenizer = [], aligner.a

    class Counted:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    aligner.a = Counted()
    texts = [" ".join(f"w{i}é{k}" for i in range(50)) for k in range(40)] + ["▁ x", "a \n b ", "z\n"]
    first = aligner.align(texts)
    assert len(given) <= 10
    del given[:]
    assert aligner.align(texts[:40]) == first[:40] and not given
    for text, found in zip(texts, first, strict=True):
        want = brute_text(text)
        assert (found and found[1].decode().split(";")) == (want and want[2])


def test_containers_hold_every_link_once():
    rng = np.random.default_rng(2)
    pairs = np.r_[rng.integers(0, 9, 20_000), np.full(6_000, 77)]
    places = rng.integers(0, CHUNK_DOCS, len(pairs))
    fields = [("chunk", pa.int64()), ("pair", pa.int64()), ("plane", pa.int32()), ("n", pa.int32()), ("bits", pa.binary())]
    got = Counter()
    kinds = set()
    for batch in alignment.containers(pairs << alignment.SLOT_BITS | places, pa.schema(fields), 8):
        for row in batch.to_pylist():
            if row["n"] <= alignment.MOST_PLACES:
                held = np.frombuffer(row["bits"], np.uint16)
            else:
                held = np.flatnonzero(np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little"))
            kinds.add(row["n"] <= alignment.MOST_PLACES)
            assert len(held) == row["n"] and row["chunk"] == 8
            weight = 1 if row["plane"] == 0 else 1 << (row["plane"] - 1)
            got.update({(row["pair"], int(p)): weight for p in held})
    assert kinds == {True, False}
    assert got == Counter(zip(pairs.tolist(), places.tolist(), strict=True))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="module")
def some_rows():
    rng = random.Random(1)
    words = ["the", "of", "running", "Straße", "überall", "x1", "naïve,", "日本"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(30)))) for i in range(120)]
    return rows + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "the of"), (5, "the of"), (5, "the of")]


def test_against_brute_force(spark, some_rows):
    want, docs, links = brute(some_rows)
    found, counts = align_tokens(frame(spark, some_rows).repartition(3), JSON, MODEL)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    got = {(r.a_id, r.b_id): (r.n_docs, r.n_links) for r in counts.collect()}
    assert got == {p: (n, links[p]) for p, n in docs.items()}


def test_counts_met_by_a_shuffle(spark, some_rows, monkeypatch):
    monkeypatch.setattr(alignment, "COUNTS_BROADCAST_BYTES", 0)
    found, _ = align_tokens(frame(spark, some_rows), JSON, MODEL)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute(some_rows)[0], key=key)


def test_many_chunks(spark, some_rows, monkeypatch):
    """Chunks cut by their links give the sums that one chunk gives."""
    monkeypatch.setattr(alignment, "CHUNK_LINKS", 50)
    index = alignment.index_documents(frame(spark, some_rows[:0]), JSON, MODEL)
    schema = [("chunk", pa.int64()), ("slot", pa.int32()), ("doc_id", pa.int64())]
    schema += [(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    schema += [("groups_sha256", pa.string()), ("pair", pa.int64()), ("plane", pa.int32()), ("n", pa.int32())]
    indexer = alignment._Indexer(TokenAligner(JSON, MODEL), pa.schema([*schema, ("bits", pa.binary())]))
    ids, texts = zip(*some_rows, strict=True)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(ids))), pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["no", "doc_id", "text"]
    )
    rows = [r for b in indexer([batch.slice(0, 70), batch.slice(70)]) for r in b.to_pylist()]
    assert len({r["chunk"] for r in rows}) > 20
    index = spark.createDataFrame([tuple(r.values()) for r in rows], index.schema)
    counts = alignment.pair_counts(index, B.get_piece_size())
    sums = {(r.chunk, r.slot): (r.n_best, r.count_sum) for r in document_scores(index, counts).collect()}
    got = [
        (r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], *sums.get((r["chunk"], r["slot"]), (0, 0)), r["groups_sha256"])
        for r in rows
        if r["slot"] is not None
    ]
    assert sorted(got, key=key) == sorted(brute(some_rows)[0], key=key)


def test_empty_table_and_other_columns(spark, some_rows):
    docs = frame(spark, some_rows[:40]).selectExpr("*", "1 AS chunk", "2 AS slot", "'x' AS pair", "3 AS `n.b`")
    found, counts = align_tokens(docs, JSON, MODEL)
    assert sorted(map(tuple, found.collect())) == sorted(brute(some_rows[:40])[0])
    found, counts = align_tokens(docs.limit(0), JSON, MODEL)
    assert found.count() == counts.count() == 0
