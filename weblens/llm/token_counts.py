"""Count the tokens of texts exactly as a SentencePiece model's library does.

A text position is a proven stable boundary if no piece of the vocabulary holds the two
characters beside it next to each other: no token can then reach over it, whatever stands
further left or right, so counts on both sides add up.

Documents longer than a chunk are cut into overlapping chunks, which are encoded with offsets
by different tasks. Neighbours are spliced at the first position of their overlap that is
proven stable and a token boundary in both encodings. Documents for which some overlap has
no such position, or whose neighbours do not agree on it, are cut again with overlaps (and
chunks) twice as long, at last as one chunk.

Texts within one chunk are counted at once. Where the vocabulary has no piece with a mark
after another character, each space after another character is a proven stable boundary,
and the library is asked only for the parts between them that a worker has not met.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from weblens.llm.common import KEY, KEY_TYPE, batch_of, row_key, share
from weblens.llm.pieces import BYTE, MARK, NORMAL, groups
from weblens.shared import cut_lineage

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
# What a worker remembers of parts in bytes, and the longest part it does.
MEMO_BYTES = 32 << 20
MEMO_CHARS = 100


class TokenCounter:
    """The library's encoder with what its vocabulary proves about boundaries."""

    def __init__(self, model_proto: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model_proto)
        model = model_pb2.ModelProto.FromString(model_proto)
        spec = model.normalizer_spec
        pieces = [p.piece for p in model.pieces if p.type != BYTE]
        # Only a normaliser that works character by character proves anything.
        self.proves = (
            not spec.precompiled_charsmap
            and spec.add_dummy_prefix
            and spec.escape_whitespaces
            and not spec.remove_extra_whitespaces
            and not model.trainer_spec.treat_whitespace_as_suffix
        )
        self.neighbours = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        # Without byte fallback the library joins neighbouring unknown characters.
        joins = not model.trainer_spec.byte_fallback
        self.known = {p.piece for p in model.pieces if p.type == NORMAL and joins} or None
        # Whether a space after any other character is stable.
        self.words = self.proves and not any(n[1] == MARK != n[0] for n in self.neighbours)
        self.forget()

    def forget(self) -> None:
        """Give up what was remembered; a worker may go on to other work."""
        self.parts: dict[str, int] = {}
        self.held = 0

    def stable(self, left: str, right: str) -> bool:
        pair = (left + right).replace(" ", MARK)
        if self.known is not None and not (pair[0] in self.known or pair[1] in self.known):
            return False
        return self.proves and pair not in self.neighbours

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of whole texts."""
        if not self.words or self.known is not None:
            return [len(ids) for ids in self.library.encode(texts, num_threads=1)]
        split = [_parts(t) for t in texts]
        distinct = set(chain.from_iterable(p for p in split if p))
        if self.held > MEMO_BYTES:
            self.forget()
        found = {p: n for p in distinct if (n := self.parts.get(p)) is not None}
        new = list(distinct.difference(found))
        encoded = self.library.encode(new, num_threads=1)
        for part, n in zip(new, map(len, encoded), strict=True):
            found[part] = n
            if len(part) <= MEMO_CHARS and self.held <= MEMO_BYTES:
                self.parts[part] = n
                self.held += 180 + 2 * len(part)
        known = found.__getitem__
        return [
            sum(map(known, parts)) if parts is not None else len(self.library.encode(text))
            for text, parts in zip(texts, split, strict=True)
        ]

    def count_chunk(self, text: str, own: int, overlap: int, first: bool, last: bool) -> tuple:
        """Splice positions of one chunk and its tokens between them.

        `own` is where the next chunk starts. Positions are None where the overlap has no
        proven stable token boundary.
        """
        offsets = self.library.encode(text, return_type="offset_mapping")["offsets"]
        begins = np.array([o[0] for o in offsets], dtype=np.int64)
        starts = set(begins.tolist())

        def boundary(low: int) -> int | None:
            for b in range(low + 1, min(low + overlap, len(text) - 1)):
                if b in starts and self.stable(text[b - 1], text[b]):
                    return b
            return None

        left = 0 if first else boundary(0)
        right = len(text) if last else boundary(own)
        if left is None or right is None:
            return left, right, 0
        inside = (begins >= left) & ((begins < right) | last)
        return left, right, int(inside.sum())


def _parts(text: str) -> list[str] | None:
    """A text cut before its spaces, each part without the space that the prefix gives it.

    None where runs of spaces or marks in the text make this cut wrong.
    """
    if MARK in text:
        return None
    parts = text.split(" ")
    if "" in parts:
        return [] if text == "" else None
    return parts


_counters: dict[bytes, TokenCounter] = {}


def counter_of(model_proto: bytes) -> TokenCounter:
    if model_proto not in _counters:
        _counters.clear()
        _counters[model_proto] = TokenCounter(model_proto)
    return _counters[model_proto]


def count_tokens(
    docs: DataFrame,
    model_proto: bytes,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = 4096,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """`(doc_id, n_bytes, n_tokens, over_limit)` for every row of `docs`.

    No begin, end or added special tokens. Null counts as empty: no bytes, no tokens.
    Repeated rows each give a row; a null id stays null. Texts of any length are counted
    whole, at most a chunk and its overlap at a time. Other columns are not read.
    """
    model = share(docs.sparkSession, model_proto)

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = counter_of(model.value)
        try:
            for batch in batches:
                found = [counter.count(g) for g in groups(batch.to_pylist())]
                yield pa.array(chain.from_iterable(found), pa.int64())
        finally:
            counter.forget()

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    long_text = F.char_length("text") > chunk_chars
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    short = rows.where(~long_text).select("doc_id", n_bytes, count("text").alias("n_tokens"))
    longer = rows.where(long_text).withColumn(KEY, row_key("doc_id", "text"))
    spliced = _spliced(longer, model, chunk_chars, overlap_chars)
    long_rows = longer.select("doc_id", n_bytes, KEY).join(spliced, KEY)
    counted = short.unionByName(long_rows.select("doc_id", "n_bytes", "n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


CHUNK = pa.schema(
    [(KEY, KEY_TYPE), ("no", pa.int64()), ("start", pa.int64()), ("own", pa.int64())]
    + [("last", pa.bool_()), ("part", pa.string())]
)
PIECE = pa.schema(
    [(KEY, KEY_TYPE), ("no", pa.int64()), ("first", pa.int64()), ("until", pa.int64())]
    + [("n_tokens", pa.int64()), ("last", pa.bool_())]
)


def _chunks(longer: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """A row per chunk: its text, with the overlap, and how much of it is its own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch[0], batch[1], strict=True):
                whole, at = text.as_py(), key.as_py()
                for no, start in enumerate(range(0, len(whole), chunk)):
                    own = min(chunk, len(whole) - start)
                    part = whole[start : start + chunk + overlap]
                    last = start + chunk >= len(whole)
                    yield batch_of([(at, no, start, own, last, part)], CHUNK)

    return longer.select(KEY, "text").mapInArrow(cut, from_arrow_schema(CHUNK))


def _encoded(chunks: DataFrame, model, overlap: int) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model.value)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                first, until, n = counter.count_chunk(
                    row["part"], row["own"], overlap, row["no"] == 0, row["last"]
                )
                ends = [None if x is None else row["start"] + x for x in (first, until)]
                out.append((row[KEY], row["no"], *ends, n, row["last"]))
            yield batch_of(out, PIECE)

    return chunks.mapInArrow(encode, from_arrow_schema(PIECE))


def _spliced(longer: DataFrame, model, chunk: int, overlap: int) -> DataFrame:
    """`(key, n_tokens)` of each different long row, spliced from its chunks."""
    if not counter_of(model.value).proves:
        chunk = 1 << 40  # nothing is proven for this normaliser: whole texts only
    left, done = longer, None
    following = F.lead("first").over(Window.partitionBy(KEY).orderBy("no"))
    meets = F.when(F.col("last"), F.col("first").isNotNull()).otherwise(
        F.col("until") == following
    )
    while True:
        # Chunks of one document go to different tasks.
        spread = _chunks(left, chunk, overlap).repartition(f"{KEY}.a", "no")
        pieces = cut_lineage(_encoded(spread, model, overlap))
        counted = (
            pieces.dropDuplicates([KEY, "no"])
            .withColumn("meets", F.coalesce(meets, F.lit(False)))
            .groupBy(KEY)
            .agg(F.sum("n_tokens").alias("n_tokens"), F.bool_and("meets").alias("whole"))
        )
        good = counted.where("whole").select(KEY, "n_tokens")
        done = good if done is None else done.unionByName(good)
        failed = counted.where("NOT whole").select(KEY)
        if failed.isEmpty():
            return done
        chunk, overlap = chunk * 2, overlap * 2
        left = left.join(cut_lineage(failed), KEY, "left_semi")
