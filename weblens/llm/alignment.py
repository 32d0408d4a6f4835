"""Which tokens of two tokenizers cover the same bytes, in each text and over the corpus.

A is a byte-level BPE of the `tokenizers` library, given a space and the text; B is a BPE or
Unigram model of `sentencepiece`, which adds that space itself. Where both have a token end at
the same byte, a group ends. Each A and B occurrence that share a byte are a link; within a
group with m and n tokens there are m + n - 1.

An inverted index holds for every pair of ids the documents that have it linked, as bitmaps:

- Documents are numbered in chunks of at most `CHUNK_DOCS` rows and `CHUNK_LINKS` links. A
  container is what a pair has in one chunk: sorted 16-bit places, or a plain bitmap once it is
  smaller.
- Plane 0 says whether a document has the pair at all. Planes k >= 1 hold bit k - 1 of its
  links beyond the first, so a link count is 1 + the planes' powers of two.
- A pair's bitmap over the corpus is its chunks' containers; those are of different documents,
  so the popcount of their union is the sum of theirs: the pair's number of documents.
- The planes go back over the chunks as postings and add each pair's count to a dense
  accumulator over the chunk's documents.

Both tokenizers work on stretches of the text: it is cut before every space that follows
something other than white space, where both have a token end whatever stands further left or
right (where a model does not prove that, the whole text is one stretch). For the same reason
A gets the new stretches of a batch as one text. A worker remembers the stretches it met, within
a bound in bytes, and forgets them when its task ends.

Null and empty texts, and those that either tokenizer does not give back byte by byte (such as
texts with U+2581, which B takes for a space), have no tokens. Each row is a document of its
own, so repeated rows count repeatedly. An empty table gives empty tables. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from weblens.llm.common import share
from weblens.llm.hashed_words import row_slices
from weblens.llm.pieces import BYTE, MARK, UNIGRAM, BPE, UNKNOWN, USER_DEFINED
from weblens.shared import broadcast_within_limit, cut_lineage

SLOT_BITS = 12
CHUNK_DOCS = 1 << SLOT_BITS
CHUNK_LINKS = 4_000_000
BITMAP_BYTES = CHUNK_DOCS // 8
MOST_PLACES = BITMAP_BYTES // 2  # more places than this are smaller as a bitmap
# What a worker may remember of stretches, and the longest stretch it does.
MEMO_BYTES = 96 << 20
MEMO_CHARS = 100
# Beyond this, counts of pairs meet their postings by a shuffle, a pair's spread over `SALTS`.
COUNTS_BROADCAST_BYTES = 64 << 20
SALTS = 16

#: A space that follows something other than white space and is not the last sign.
CUT = re.compile(r"(?<=\S) (?!\Z)")
BLANK_RUN = re.compile(r"\s ")


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write bytes as signs: printable ones as they are, others from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    signs = {chr(b): b for b in plain}
    signs.update({chr(256 + i): b for i, b in enumerate(others)})
    return signs


class TokenAligner:
    """Both tokenizers and the bytes of their tokens, with a bounded memory of stretches."""

    def __init__(self, tokenizer_json: bytes, model_proto: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(tokenizer_json.decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_proto)
        byte_of = _byte_of_sign()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token if c in byte_of)
        model = model_pb2.ModelProto.FromString(model_proto)
        self.b_bytes = []
        for piece in model.pieces:
            if piece.type == BYTE:
                self.b_bytes.append(bytes([int(piece.piece[3:-1], 16)]))
            else:
                self.b_bytes.append(piece.piece.replace(MARK, " ").encode())
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        self.b_size = len(self.b_bytes)
        numbers = [str(i) + " " for i in range(max(len(self.a_bytes), self.b_size))]
        self.digits = np.frombuffer("".join(numbers).encode(), np.uint8)
        self.digits_of = np.array(list(map(len, numbers))) - 1
        self.digits_at = np.cumsum(self.digits_of + 1) - self.digits_of - 1
        self.cuts = _proves_a(json.loads(tokenizer_json)) and _proves_b(model)
        self.new: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        self.held = 0

    def stretches(self, text: str) -> list[str]:
        """The text cut where both tokenizers surely end a token; the space before is left out."""
        if not self.cuts or MARK in text:
            return [text]
        if text[0] != " " and text[-1] != " " and not BLANK_RUN.search(text):
            return text.split(" ")
        return CUT.split(text)

    def align(self, texts: list[str]) -> list[tuple[bytes, bytes, int, int] | None]:
        """Links, groups and token counts of each text; None where it has no tokens."""
        split = [self.stretches(t) if t else [] for t in texts]
        passing = self._look_up(set(chain.from_iterable(split)))
        get = self.new.__getitem__
        out: list = []
        for parts in split:
            entries = list(map(get, parts))
            if not entries or None in entries:
                out.append(None)
                continue
            links, groups, tokens = zip(*entries, strict=True)
            n = sum(tokens)
            out.append((b"".join(links), b";".join(groups), n >> 40, n & ((1 << 40) - 1)))
        for stretch in passing:
            del self.new[stretch]
        if 2 * self.held > MEMO_BYTES:
            self._rotate()
        return out

    def _look_up(self, stretches: set[str]) -> list[str]:
        """Put the entries of all these stretches into `new`; those it must not keep come back."""
        absent = stretches.difference(self.new)
        known = absent.intersection(self.old)
        self._remember({s: self.old[s] for s in known})
        missing = absent.difference(known)
        # Laid end to end, these have a cut of the text between any two of them.
        joined = [s for s in missing if not s[-1].isspace() and MARK not in s] if self.cuts else []
        apart = list(missing.difference(joined))
        entries = dict(zip(joined, self._joined_entries(joined), strict=True))
        entries.update(zip(apart, self._entries(apart), strict=True))
        passing = [s for s, e in entries.items() if e is None or len(s) > MEMO_CHARS]
        self.new.update((s, entries.pop(s)) for s in passing)
        self._remember(entries)
        return passing

    def _remember(self, entries: dict[str, tuple]) -> None:
        self.new.update(entries)
        self.held += 400 * len(entries) + 4 * sum(map(len, entries))
        self.held += sum([len(links) + len(groups) for links, groups, _ in entries.values()])

    def _rotate(self) -> None:
        """What was met last becomes the older half; the earliest beyond a half goes."""
        gone = []
        for stretch, (links, groups, _) in self.new.items():
            if 2 * self.held <= MEMO_BYTES:
                break
            self.held -= 400 + 4 * len(stretch) + len(links) + len(groups)
            gone.append(stretch)
        for stretch in gone:
            del self.new[stretch]
        self.old, self.new, self.held = self.new, {}, 0

    def _joined_entries(self, stretches: list[str]) -> list[tuple | None]:
        """`_entries` of stretches that end a token of A wherever they stand: A gets one text."""
        if not stretches:
            return []
        text = " " + " ".join(stretches)
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = list(chain.from_iterable(self.b.encode(stretches, num_threads=1)))
        whole = [text.encode()]
        if not self._same(self.a_bytes, a, whole) or not self._same(self.b_bytes, b, whole):
            return self._entries(stretches)
        ends = np.cumsum([len(s.encode()) + 1 for s in stretches])
        return self._align(np.array(a, np.int64), np.array(b, np.int64), ends)

    def _entries(self, stretches: list[str]) -> list[tuple | None]:
        """Links, groups and token counts of each stretch; None where bytes got lost."""
        spaced = [" " + s for s in stretches]
        a_ids = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        b_ids = self.b.encode(stretches, num_threads=1)
        whole = [s.encode() for s in spaced]
        if not self._same(self.a_bytes, chain.from_iterable(a_ids), whole) or not self._same(
            self.b_bytes, chain.from_iterable(b_ids), whole
        ):  # some stretch is changed: each one by itself
            good = [
                self._same(self.a_bytes, a, [w]) and self._same(self.b_bytes, b, [w])
                for a, b, w in zip(a_ids, b_ids, whole, strict=True)
            ]
            a_ids, b_ids, whole = (
                [x for x, fine in zip(xs, good, strict=True) if fine]
                for xs in (a_ids, b_ids, whole)
            )
            aligned = iter(self._align(*self._flat(a_ids, b_ids, whole)))
            return [next(aligned) if fine else None for fine in good]
        return self._align(*self._flat(a_ids, b_ids, whole))

    @staticmethod
    def _flat(a_ids: list, b_ids: list, whole: list[bytes]) -> tuple[np.ndarray, ...]:
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a_ids, b_ids))
        return a, b, np.cumsum(list(map(len, whole)))

    @staticmethod
    def _same(bytes_of: list[bytes], ids: Iterable[int], whole: list[bytes]) -> bool:
        return b"".join(map(bytes_of.__getitem__, ids)) == b"".join(whole)

    def _align(self, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> list[tuple]:
        """All stretches at once, laid end to end: both sides' tokens cut the same bytes.

        Between two neighbouring cuts of either side lies just one token of each: a link.
        Where both cut, a group ends.
        """
        if not len(ends):
            return []
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_cuts, b_cuts = (np.zeros(int(ends[-1]) + 1, bool) for _ in range(2))
        a_cuts[a_ends], b_cuts[b_ends] = True, True
        cuts, closes = np.flatnonzero(a_cuts | b_cuts), np.flatnonzero(a_cuts & b_cuts)
        pairs = a[np.searchsorted(a_ends, cuts)] * self.b_size + b[np.searchsorted(b_ends, cuts)]
        links, links_to = pairs.tobytes(), np.searchsorted(cuts, ends, "right") * 8

        a_group, b_group = np.searchsorted(closes, a_ends), np.searchsorted(closes, b_ends)
        a_upto, b_upto = (
            np.cumsum(np.bincount(g, minlength=len(closes))) for g in (a_group, b_group)
        )
        ids = np.empty(len(a) + len(b), np.int64)  # by group, A's before B's
        after = np.full(len(ids), ord(","), np.uint8)
        ids[np.arange(len(a)) + np.r_[0, b_upto][a_group]] = a
        ids[np.arange(len(b)) + a_upto[b_group]] = b
        after[a_upto + np.r_[0, b_upto[:-1]] - 1] = ord("|")
        after[a_upto + b_upto - 1] = ord(";")
        sizes = self.digits_of[ids] + 1
        to = np.cumsum(sizes)
        at = np.repeat(self.digits_at[ids] - (to - sizes), sizes) + np.arange(to[-1])
        text = self.digits[at]
        text[to - 1] = after
        groups = text.tobytes()
        last = np.searchsorted(closes, ends, "right") - 1
        groups_to = to[a_upto[last] + b_upto[last] - 1]
        tokens = (a_upto[last] << 40) + b_upto[last]
        tokens[1:] -= tokens[:-1].copy()
        out, low, begin = [], 0, 0
        for high, end, n in zip(links_to.tolist(), groups_to.tolist(), tokens.tolist(), strict=True):
            out.append((links[low:high], groups[begin : end - 1], n))
            low, begin = high, end
        return out


def _proves_a(spec: dict) -> bool:
    """Whether A cuts texts into words by itself, spaces in front, and changes nothing else."""
    before = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and bool(before.get("use_regex"))
        and all(t["special"] for t in spec.get("added_tokens") or [])
    )


def _proves_b(model) -> bool:
    """Whether B changes only spaces, and has no piece with a space after another sign."""
    spec, trainer = model.normalizer_spec, model.trainer_spec
    return (
        trainer.model_type in (UNIGRAM, BPE)
        and not spec.precompiled_charsmap
        and spec.add_dummy_prefix
        and spec.escape_whitespaces
        and not spec.remove_extra_whitespaces
        and not trainer.treat_whitespace_as_suffix
        and not any(
            p.type == USER_DEFINED or (p.type not in (BYTE, UNKNOWN) and MARK in p.piece.lstrip(MARK))
            for p in model.pieces
        )
    )


def containers(keys: np.ndarray, schema: pa.Schema, chunk: int) -> Iterator[pa.RecordBatch]:
    """The bitmaps of a chunk out of its links, each `pair << SLOT_BITS | place`."""
    keys, links = np.unique(keys, return_counts=True)
    yield from _containers_of_plane(keys, schema, chunk, 0)
    more, plane = links - 1, 1
    while more.any():
        keys, more = keys[more > 0], more[more > 0]
        odd = (more & 1) == 1
        if odd.any():
            yield from _containers_of_plane(keys[odd], schema, chunk, plane)
        more >>= 1
        plane += 1


def _containers_of_plane(
    keys: np.ndarray, schema: pa.Schema, chunk: int, plane: int
) -> Iterator[pa.RecordBatch]:
    pairs, places = keys >> SLOT_BITS, (keys & (CHUNK_DOCS - 1)).astype(np.uint16)
    begins = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    sizes = np.diff(np.r_[begins, len(pairs)])
    small = sizes <= MOST_PLACES
    if small.any():
        kept = places[np.repeat(small, sizes)]
        ends = np.r_[0, np.cumsum(sizes[small] * 2)].astype(np.int32)
        data = [None, pa.py_buffer(ends), pa.py_buffer(kept.tobytes())]
        bits = pa.BinaryArray.from_buffers(pa.binary(), int(small.sum()), data)
        yield _rows(schema, chunk=chunk, pair=pairs[begins[small]], plane=plane, n=sizes[small], bits=bits)
    dense = np.flatnonzero(~small)
    if len(dense):
        bits = []
        for at in dense:
            flags = np.zeros(CHUNK_DOCS, bool)
            flags[places[begins[at] : begins[at] + sizes[at]]] = True
            bits.append(np.packbits(flags, bitorder="little").tobytes())
        yield _rows(schema, chunk=chunk, pair=pairs[begins[dense]], plane=plane, n=sizes[dense], bits=bits)


def _rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch of the columns named; single values are repeated, other columns null."""
    n = max(len(c) for c in columns.values() if not isinstance(c, int))
    arrays = []
    for field in schema:
        value = columns.get(field.name)
        if value is None:
            arrays.append(pa.nulls(n, field.type))
        elif isinstance(value, int):
            arrays.append(pa.array(np.full(n, value), field.type))
        elif isinstance(value, pa.Array):
            arrays.append(value)
        else:
            arrays.append(pa.array(value, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class _Indexer:
    """Rows of documents and containers of pairs, chunk by chunk."""

    def __init__(self, aligner: TokenAligner, schema: pa.Schema):
        self.aligner, self.schema = aligner, schema

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        self._begin()
        for batch in batches:
            at = 0
            for part in row_slices(batch.column(2), 1 << 20):
                rows = batch.slice(at, len(part))
                at += len(part)
                texts = part.to_pylist()
                numbers = rows.column(0).to_pylist()
                ids = rows.column(1)
                low = 0
                aligned = self.aligner.align(texts)
                for i, found in enumerate(aligned):
                    if self.chunk is None:
                        self.chunk = numbers[i]
                    self._add(found)
                    if len(self.rows) == CHUNK_DOCS or self.n_links >= CHUNK_LINKS:
                        self.ids.append(ids.slice(low, i + 1 - low))
                        low = i + 1
                        yield from self._flush()
                if low < len(aligned):
                    self.ids.append(ids.slice(low))
        if self.rows:
            yield from self._flush()

    def _begin(self) -> None:
        self.chunk: int | None = None
        self.rows: list[tuple] = []
        self.ids: list[pa.Array] = []
        self.links: list[np.ndarray] = []
        self.n_links = 0

    def _add(self, found: tuple | None) -> None:
        if found is None:
            self.rows.append((0, 0, 0, 0, ""))
            return
        links, groups, n_a, n_b = found
        pairs = np.frombuffer(links, np.int64)
        self.links.append(pairs << SLOT_BITS | len(self.rows))
        self.n_links += len(pairs)
        digest = hashlib.sha256(groups).hexdigest()
        self.rows.append((n_a, n_b, groups.count(b";") + 1, len(pairs), digest))

    def _flush(self) -> Iterator[pa.RecordBatch]:
        names = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        columns = dict(zip(names, map(list, zip(*self.rows, strict=True)), strict=True))
        places = list(range(len(self.rows)))
        ids = pa.concat_arrays(self.ids)
        yield _rows(self.schema, chunk=self.chunk, slot=places, doc_id=ids, **columns)
        if self.links:
            keys = np.concatenate(self.links)
            self.links.clear()
            yield from containers(keys, self.schema, self.chunk)
        self._begin()


_aligners: dict[bytes, TokenAligner] = {}


def index_documents(docs: DataFrame, tokenizer_json: bytes, model_proto: bytes) -> DataFrame:
    """Rows of documents (`slot` is set) and of bitmap containers (`pair` is set), by chunk.

    Chunks are named by the number of their first row. Write this before it is used: the
    numbers hold for one reading of `docs`.
    """
    models = share(docs.sparkSession, (tokenizer_json, model_proto))
    kind = docs.schema["doc_id"].dataType
    schema = (
        f"chunk long, slot int, doc_id {kind.simpleString()}, n_a long, n_b long, n_groups long,"
        " n_links long, groups_sha256 string, pair long, plane int, n int, bits binary"
    )
    fields = [
        ("chunk", pa.int64()),
        ("slot", pa.int32()),
        ("doc_id", to_arrow_type(kind)),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("pair", pa.int64()),
        ("plane", pa.int32()),
        ("n", pa.int32()),
        ("bits", pa.binary()),
    ]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        which = hashlib.sha256(models.value[0] + models.value[1]).digest()
        if which not in _aligners:
            _aligners.clear()
            _aligners[which] = TokenAligner(*models.value)
        aligner = _aligners[which]
        try:
            yield from _Indexer(aligner, pa.schema(fields))(batches)
        finally:
            aligner.new, aligner.old, aligner.held = {}, {}, 0

    numbered = docs.select(F.monotonically_increasing_id().alias("no"), "doc_id", "text")
    return numbered.mapInArrow(index, schema)


def pair_counts(index: DataFrame, b_size: int) -> DataFrame:
    """`(pair, a_id, b_id, n_docs, n_links, best)` of every pair that is linked anywhere.

    `best` says whether no pair of the same A id is in more documents. An A id has at most as
    many pairs as B has ids, so its window is bounded.
    """
    weight = F.expr("CASE WHEN plane = 0 THEN 1L ELSE shiftleft(1L, plane - 1) END")
    found = index.where("pair IS NOT NULL").groupBy("pair")
    found = found.agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n")).otherwise(0)).alias("n_docs"),
        F.sum(weight * F.col("n")).alias("n_links"),
    )
    found = found.withColumn("a_id", F.expr(f"pair div {b_size}"))
    found = found.withColumn("b_id", F.expr(f"pair % {b_size}"))
    most = F.max("n_docs").over(Window.partitionBy("a_id"))
    found = found.withColumn("best", F.col("n_docs") == most)
    return found.select("pair", "a_id", "b_id", "n_docs", "n_links", "best")


SCORES = pa.schema(
    [("chunk", pa.int64()), ("slot", pa.int32()), ("count_sum", pa.int64()), ("n_best", pa.int64())]
)


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add each pair's count to the documents its planes name, chunk by chunk."""
    held: dict[int, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for chunk, sums in held.items():
            at = np.flatnonzero(sums[0])
            arrays = [np.full(len(at), chunk), at, sums[0, at], sums[1, at]]
            columns = [pa.array(a, f.type) for a, f in zip(arrays, SCORES, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=SCORES)
        held.clear()

    for batch in batches:
        chunks, planes, n, count = (batch.column(i).to_numpy() for i in range(4))
        best = batch.column(4).to_numpy(zero_copy_only=False)
        weight = np.where(planes == 0, 1, np.left_shift(1, np.maximum(planes - 1, 0)))
        value = weight * count
        best = weight * best
        bits = batch.column(5)
        for chunk in np.unique(chunks):
            if chunk not in held:
                if len(held) >= 32:
                    yield from flush()
                held[int(chunk)] = np.zeros((2, CHUNK_DOCS), np.int64)
            sums = held[int(chunk)]
            mine = chunks == chunk
            few = np.flatnonzero(mine & (n <= MOST_PLACES))
            raw = b"".join(bits.take(pa.array(few)).to_pylist())
            places = np.frombuffer(raw, np.uint16)
            for row, values in ((0, value), (1, best)):
                np.add.at(sums[row], places, np.repeat(values[few], n[few]))
            for i in np.flatnonzero(mine & (n > MOST_PLACES)):
                raw = np.frombuffer(bits[int(i)].as_py(), np.uint8)
                flags = np.unpackbits(raw, bitorder="little").astype(bool)
                sums[0, flags] += value[i]
                sums[1, flags] += best[i]
    yield from flush()


def document_scores(index: DataFrame, counts: DataFrame) -> DataFrame:
    """`(chunk, slot, count_sum, n_best)`: the counts of a document's links, from the postings."""
    postings = index.where("pair IS NOT NULL").select("pair", "chunk", "plane", "n", "bits")
    counts = counts.select("pair", "n_docs", "best")
    marked = broadcast_within_limit(counts, COUNTS_BROADCAST_BYTES)
    if marked is not counts:
        met = postings.join(marked, "pair")
    else:  # a frequent pair has a row a chunk, so it is spread
        salt = F.pmod(F.xxhash64("chunk"), F.lit(SALTS)).alias("salt")
        salts = F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt")
        met = postings.select("*", salt).join(counts.select("*", salts), ["pair", "salt"])
        met = met.repartition("chunk").sortWithinPartitions("chunk")
    met = met.select("chunk", "plane", "n", "n_docs", "best", "bits")
    scores = met.mapInArrow(_score, "chunk long, slot int, count_sum long, n_best long")
    return scores.groupBy("chunk", "slot").agg(
        F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best")
    )


def align_tokens(
    docs: DataFrame, tokenizer_json: bytes, model_proto: bytes
) -> tuple[DataFrame, DataFrame]:
    """Each document's alignment, and each pair of ids with its counts over the corpus.

    The first has `(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)` for
    every row of `docs`, the second is `pair_counts`.
    """
    model = model_pb2.ModelProto.FromString(model_proto)
    index = cut_lineage(index_documents(docs, tokenizer_json, model_proto))
    counts = cut_lineage(pair_counts(index, len(model.pieces)))
    scores = document_scores(index, counts)
    rows = index.where("slot IS NOT NULL").drop("pair", "plane", "n", "bits")
    rows = rows.join(scores, ["chunk", "slot"], "left").na.fill(0, ["count_sum", "n_best"])
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256"
    return rows.select(*names.split()), counts
