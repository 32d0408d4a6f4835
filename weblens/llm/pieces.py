"""Encode and decode text with the vocabulary of a SentencePiece model.

Normalised text is cut into marked words: a run of marks (U+2581, which stands for a space)
and what follows up to the next mark. No piece of the vocabulary has a mark after another
character, so no piece can reach over that cut and words are encoded one by one. (For a
vocabulary that has such a piece, a whole text counts as one word.)

The distinct new words of a batch are sorted, which lays out their trie in depth-first order:
the forward states of a word's first characters are those of the word before it, as far as
both agree, and only the rest is computed.

- Unigram models: a forward state is the best score of any segmentation of the prefix and
  the piece that ends it (Viterbi).
- BPE models: the best sum of scores is not what merging gives. Here the state is the piece
  that ends the prefix when it is merged. There is exactly one: the merges inside a prefix do
  not depend on what follows, and a chain of pieces is the result of merging if and only if
  each neighbouring pair is the result for its own two texts. So a forward state asks only
  for a piece that ends here and is compatible with the state before it.

Both give the ids that the model's own library gives.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from weblens.llm.common import free_name, release_memory, share
from weblens.llm.hashed_words import row_slices

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, BYTE, USER_DEFINED = 1, 2, 6, 4
# What a worker remembers of words in bytes, the longest word it does, and the pairs of
# pieces whose compatibility it keeps. Of each, the half it has not met lately goes.
MEMO_BYTES = 80 << 20
MEMO_CHARS = 100
MEMO_PAIRS = 600_000
# Texts are worked on in groups of at least so many characters, rows in runs of so many bytes.
GROUP_CHARS = 1 << 20
RUN_BYTES = 2 << 20
CHAR_BITS = 21  # a trie's step is a node and a character
NOTHING = 1 << 23  # stands for what is before a word; ids and characters are smaller
PAIR = 1 << 24
UNKNOWN_PENALTY = 10.0  # fixed value of Unigram models: below the least score by so much


class PieceCoder:
    """The vocabulary of one model, with a bounded memory of words."""

    def __init__(self, model_proto: bytes):
        model = model_pb2.ModelProto.FromString(model_proto)
        self.kind = model.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only Unigram and BPE models are supported")
        if any(p.type == USER_DEFINED for p in model.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model_proto)
        spec = model.normalizer_spec
        self.plain = (
            not spec.precompiled_charsmap
            and spec.add_dummy_prefix
            and spec.escape_whitespaces
            and not spec.remove_extra_whitespaces
            and not model.trainer_spec.treat_whitespace_as_suffix
        )
        self.prefixed = spec.add_dummy_prefix
        self.size = len(model.pieces)
        self.pieces = [p.piece for p in model.pieces]
        self.scores_by_id = [p.score for p in model.pieces]
        self.scores: dict[str, float] = {}
        # A trie of the vocabulary: from a node by a character, and the piece that ends there.
        self.steps: dict[int, int] = {}
        self.piece_at = [-1]
        self.byte_ids: list[int] = [0] * 256
        self.unknown = 0
        self.falls_back = model.trainer_spec.byte_fallback
        self.bytes_of: list[bytes] = []
        for i, piece in enumerate(model.pieces):
            out = b""
            if piece.type == NORMAL:
                node = 0
                for char in piece.piece:
                    step = node << CHAR_BITS | ord(char)
                    node = self.steps.setdefault(step, len(self.piece_at))
                    if node == len(self.piece_at):
                        self.piece_at.append(-1)
                self.piece_at[node] = i
                self.scores[piece.piece] = piece.score
                out = piece.piece.replace(MARK, " ").encode()
            elif piece.type == BYTE:
                value = int(piece.piece[3:-1], 16)
                self.byte_ids[value] = i
                out = bytes([value])
            elif piece.type == UNKNOWN:
                self.unknown = i
                out = model.trainer_spec.unk_surface.encode()
            self.bytes_of.append(out)
        crossing = any(MARK in p.lstrip(MARK) for p in self.scores)
        self.quick = self.plain and not crossing
        self.word = re.compile(r"(?s).+" if crossing else rf"{MARK}*[^{MARK}]+|{MARK}+")
        self.unknown_score = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.forget()

    def forget(self) -> None:
        """Give up what was remembered; a worker may go on to other work."""
        self.pairs: dict[int, bool] = {}
        self.older_pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def rest(self) -> None:
        """Keep what the next task most likely needs, at most half the bound, and the pairs."""
        self.older = {}

    # --- encoding

    def normalise(self, text: str) -> str:
        if not self.plain:
            return self.library.normalize(text)
        return MARK + text.replace(" ", MARK) if text else ""

    def marked_words(self, text: str) -> list[str]:
        if self.quick and MARK not in text:
            parts = text.split(" ")
            if "" not in parts:  # no runs of spaces, and text at all
                return [MARK + p for p in parts]
        return self.word.findall(self.normalise(text))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(row, np.int32).tolist() for row in self.encode_rows(texts)]

    def encode_rows(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit numbers laid end to end."""
        split = [self.marked_words(t) for t in texts]
        found: dict[str, bytes] = {}
        new = []
        for word in set(chain.from_iterable(split)):
            ids = self.words.get(word)
            if ids is None:
                ids = self.older.get(word)
                if ids is None:
                    new.append(word)
                    continue
                self._remember(word, ids)
            found[word] = ids
        new.sort()
        for word, ids in zip(new, self._learn(new), strict=True):
            found[word] = ids
            if len(word) <= MEMO_CHARS:
                self._remember(word, ids)
        return [b"".join(map(found.__getitem__, words)) for words in split]

    def _remember(self, word: str, ids: bytes) -> None:
        self.words[word] = ids
        self.held += 250 + 2 * len(word) + len(ids)
        if 2 * self.held > MEMO_BYTES:  # words met since stay, older ones go
            self.older, self.words, self.held = self.words, {}, 0

    def _learn(self, words: list[str]) -> Iterator[bytes]:
        """Depth-first over the trie of sorted words; the ids of each.

        The lists have an entry for each prefix of the word at hand: the pieces of the
        vocabulary that may still go on (where each began and its node in the vocabulary's
        trie), and the forward state: where the prefix's last piece begins, its id, and the
        score.
        """
        merges, size = self.kind == BPE, self.size
        steps, piece_at, compatible = self.steps, self.piece_at, self._compatible
        open_pieces: list[list] = [[]]
        begins, last, scores = [0], [NOTHING], [0.0]
        before = ""
        for word in words:
            same, most = 0, min(len(before), len(word))
            while same < most and before[same] == word[same]:
                same += 1
            for kept in (open_pieces, begins, last, scores):
                del kept[same + 1 :]
            pairs = self.pairs
            for at in range(same, len(word)):
                char = ord(word[at])
                going, ending = [], []
                for begin, node in open_pieces[at]:
                    node = steps.get(node << CHAR_BITS | char)
                    if node is not None:
                        going.append((begin, node))
                        if piece_at[node] >= 0:
                            ending.append((begin, piece_at[node]))
                open_pieces.append(going)
                alone = size + char
                node = steps.get(char)
                if node is not None:
                    going.append((at, node))
                    if piece_at[node] >= 0:
                        alone = piece_at[node]
                if not merges:
                    self._best(ending, at, alone, begins, last, scores)
                    continue
                for begin, found in ending:  # the longest first; only one fits
                    pair = last[begin] * PAIR + found
                    fits = pairs.get(pair)
                    if fits or (fits is None and compatible(pair, last[begin], found)):
                        begins.append(begin)
                        last.append(found)
                        break
                else:
                    begins.append(at)
                    last.append(alone)
            before = word
            yield array("i", self._ids_of(begins, last)).tobytes()

    def _best(self, ending, at, alone, begins, last, scores) -> None:
        """The usual Viterbi step: the piece that makes the best sum of scores."""
        score = self.scores_by_id[alone] if alone < self.size else self.unknown_score
        begin, piece, best = at, alone, scores[at] + score
        for start, found in ending:
            score = scores[start] + self.scores_by_id[found]
            if score > best or (score == best and start < begin):
                begin, piece, best = start, found, score
        begins.append(begin)
        last.append(piece)
        scores.append(best)

    def _text_of(self, piece: int) -> str:
        return self.pieces[piece] if piece < self.size else chr(piece - self.size)

    def _compatible(self, pair: int, left: int, right: int) -> bool:
        fits = self.older_pairs.get(pair)
        if fits is None:
            expected = [self._text_of(p) for p in (left, right) if p != NOTHING]
            fits = self.merge("".join(expected)) == expected
        self.pairs[pair] = fits
        if 2 * len(self.pairs) > MEMO_PAIRS:
            # The same dictionary goes on, as `_learn` holds it.
            self.older_pairs = dict(self.pairs)
            self.pairs.clear()
        return fits

    def merge(self, text: str) -> list[str]:
        """Merging by its definition: best-scored pair first, then the leftmost."""
        parts, scores = list(text), self.scores
        while True:
            found = [
                (-scores[p], i)
                for i in range(len(parts) - 1)
                if (p := parts[i] + parts[i + 1]) in scores
            ]
            if not found:
                return parts
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _ids_of(self, begins: list[int], last: list[int]) -> list[int]:
        out: list[int] = []
        end = len(begins) - 1
        while end:
            piece = last[end]
            if piece < self.size:
                out.append(piece)
            elif self.falls_back:
                out.extend(self.byte_ids[b] for b in reversed(self._text_of(piece).encode()))
            elif not (out and out[-1] == self.unknown):  # the library joins unknown neighbours
                out.append(self.unknown)
            end = begins[end]
        return out[::-1]

    # --- decoding

    def decode(self, ids) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        if self.prefixed and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", errors="replace")


_coders: dict[bytes, PieceCoder] = {}


def coder_of(model_proto: bytes) -> PieceCoder:
    """One coder per worker and model."""
    if model_proto not in _coders:
        _coders.clear()
        _coders[model_proto] = PieceCoder(model_proto)
    return _coders[model_proto]


def groups(texts: list[str | None]) -> Iterator[list[str]]:
    """Texts in order, some at a time; null as empty."""
    group: list[str] = []
    chars = 0
    for text in texts:
        group.append(text or "")
        chars += len(group[-1])
        if chars >= GROUP_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


def int_lists(rows: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int64) // 4
    flat = np.frombuffer(b"".join(rows), np.int32)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_pieces(
    docs: DataFrame,
    model_proto: bytes,
    text: str = "text",
    out: str = "piece_ids",
    decoded: str | None = None,
) -> DataFrame:
    """`docs` with the ids of each text's pieces in the column `out`.

    With `decoded`, a column of that name gets the text that the ids decode to, worked out
    in the same pass. Null and empty texts have no pieces and decode to empty text. Ids stay
    in one row, in order, however long the text is. Rows are encoded one by one, so repeated
    rows get equal lists. Columns already named so are replaced; all others are kept,
    whatever their names.
    """
    model = share(docs.sparkSession, model_proto)
    both = decoded is not None

    def ids_and_texts(coder: PieceCoder, texts: list[str | None]) -> tuple[list, list]:
        ids, back = [], []
        for group in groups(texts):
            rows = coder.encode_rows(group)
            ids.append(int_lists(rows))
            if both:
                decoded_rows = (coder.decode(np.frombuffer(r, np.int32).tolist()) for r in rows)
                back.append(pa.array(decoded_rows, pa.string()))
        return ids, back

    @F.arrow_udf("struct<ids:array<int>,text:string>" if both else "array<int>")
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # Results leave some rows at a time, so a worker never holds those of a whole batch.
        coder = coder_of(model.value)
        try:
            for part in chain.from_iterable(row_slices(p, RUN_BYTES) for p in parts):
                ids, back = ids_and_texts(coder, part.to_pylist())
                coded = pa.concat_arrays(ids or [pa.array([], pa.list_(pa.int32()))])
                if both:
                    texts = pa.concat_arrays(back or [pa.array([], pa.string())])
                    coded = pa.StructArray.from_arrays([coded, texts], names=["ids", "text"])
                yield coded
        finally:
            coder.rest()
            release_memory()

    if not both:
        return docs.withColumn(out, encode(F.col(text)))
    both_columns = free_name(docs, "coded")
    coded = docs.withColumn(both_columns, encode(F.col(text)))
    coded = coded.withColumn(out, F.col(both_columns)["ids"])
    return coded.withColumn(decoded, F.col(both_columns)["text"]).drop(both_columns)


def decode_pieces(
    docs: DataFrame, model_proto: bytes, ids: str = "piece_ids", out: str = "decoded"
) -> DataFrame:
    """`docs` with the text of each list of ids in the column `out`; null for a null list.

    An id outside the vocabulary is an error, a null within a list counts as no id.
    """
    model = share(docs.sparkSession, model_proto)

    @F.arrow_udf("string")
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = coder_of(model.value)
        for part in parts:
            yield pa.array(
                [
                    None if row is None else coder.decode(i for i in row if i is not None)
                    for row in (x.as_py() for x in part)
                ],
                pa.string(),
            )

    return docs.withColumn(out, decode(F.col(ids)))
