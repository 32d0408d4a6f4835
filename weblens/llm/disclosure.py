"""Personal data in texts, and the words beside it that give it away.

Four kinds are found by their form: e-mail addresses, IP addresses, card and phone numbers. Each
distinct value is a protected entity. How strongly a word reveals one is estimated from the
corpus: with n documents, of which n_e hold the entity, n_t the word and n_te the word within
`WINDOW` words of the entity,

    information of the entity   IC = log2(n / n_e)
    what the word tells of it   PMI = log2(n * n_te / (n_t * n_e))

A word beside an entity is generalised where PMI >= `GENERALISE` * IC and removed where
PMI >= `REMOVE` * IC, as it then says almost as much as the entity itself. That counts only if the
two met in at least `LEAST_CONTEXTS` different windows: one meeting, or any number of copies of
it, is no statistic. All counts are over all documents and whole texts.

Words are runs of letters and characters beyond ASCII, A-Z in lower case, none inside personal
data. Null and empty texts have nothing. Each row is a document of its own, so repeated rows count
repeatedly, and each gets its spans. An empty table gives no rows. Other columns are ignored by
`find_private` and kept by `sanitise`, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from weblens.llm.common import free_name, row_key, share
from weblens.llm.divergence import term_parts
from weblens.llm.hashed_words import row_slices
from weblens.shared import broadcast_within_limit, cut_lineage

KINDS = ("email", "ip", "card", "phone")
WINDOW = 8
LEAST_CONTEXTS = 3
GENERALISE = 0.8
REMOVE = 0.9
# Words a worker counts before it gives them away, and rows it gives away at once.
COUNTED_WORDS = 200_000
ROWS_AT_ONCE = 20_000

# The forms of personal data, each matched from the left without overlap. The
# first two are written so that long runs of their signs are passed once.
LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
NO_DIGIT = re.compile(r"[^0-9]+")
LOWER = {c: c + 32 for c in range(65, 91)}
LUHN_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From every @ back over the signs before it, up to the match before."""
    low = 0
    for found in DOMAIN.finditer(text):
        at = start = found.start()
        while start > low and text[start - 1] in LOCAL_SIGNS:
            start -= 1
        if start < at:
            low = found.end()
            yield start, low


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    values = list(map(int, digits))
    total = sum(values[-1::-2]) + sum(LUHN_DOUBLED[d] for d in values[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """`(kind, start, end)` of personal data, by kind and place."""
    out = [("email", *span) for span in emails(text)] if "@" in text else []
    for found in IP.finditer(text):
        parts = [p.lstrip("0") for p in found[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append(("ip", *found.span()))
    for found in CARD.finditer(text):
        if found.end() - found.start() >= 13:
            digits = NO_DIGIT.sub("", found[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *found.span()))
    if "+" in text:
        for found in PHONE.finditer(text):
            if 9 <= len(NO_DIGIT.sub("", found[0])) <= 15:
                out.append(("phone", *found.span()))
    return out


def entity_of(kind: str, value: str) -> str:
    """One name for all spellings of a value."""
    value = NO_DIGIT.sub("", value) if kind in ("card", "phone") else value.translate(LOWER)
    return f"{kind}:{value}"


def _words_beside(text: str, start: int, end: int, most: int) -> list[re.Match]:
    """The last `most` words before `start` and the first `most` after `end`."""
    reach, before = 16 * most, []
    while True:
        low = max(start - reach, 0)
        before = list(WORD.finditer(text, low, start))
        if low == 0 or len(before) > most:  # the first of more may have begun before `low`
            break
        reach *= 2
    after = []
    for found in WORD.finditer(text, end):
        after.append(found)
        if len(after) == most:
            break
    return before[-most:] + after


def meetings(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple]:
    """`(entity, word, first, context, start, end)` of each word beside each span.

    `first` tells the first meeting of the two in this text; a row without a word tells the
    first of an entity. `context` is a hash of all words beside the span.
    """
    plain, at = [], 0
    for low, high in sorted((s, e) for _, s, e in spans):  # personal data holds no words
        if high > at:
            low = max(low, at)
            plain += [text[at:low], "0" * (high - low)]
            at = high
    bare = "".join([*plain, text[at:]])
    met: set[tuple] = set()
    for kind, start, end in spans:
        entity = entity_of(kind, text[start:end])
        if (entity, None) not in met:
            met.add((entity, None))
            yield entity, None, 1, None, None, None
        beside = _words_beside(bare, start, end, WINDOW)
        words = [w[0].translate(LOWER) for w in beside]
        context = xxhash.xxh3_64_intdigest(" ".join(words)) - (1 << 63)
        for word, place in zip(words, beside, strict=True):
            first = (entity, word) not in met
            met.add((entity, word))
            yield entity, word, int(first), context, *place.span()


FIELDS = [
    ("n_email", pa.int64()),
    ("n_ip", pa.int64()),
    ("n_card", pa.int64()),
    ("n_phone", pa.int64()),
    ("base", pa.string()),
    ("entity", pa.string()),
    ("word", pa.string()),
    ("first", pa.int32()),
    ("context", pa.int64()),
    ("start", pa.int64()),
    ("end", pa.int64()),
    ("docs", pa.int64()),
]


class _Scanner:
    """Rows of documents (`base` is set), of meetings (`entity`) and of counted words (`docs`)."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.counted: Counter = Counter()
        self.met: list[tuple] = []

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in row_slices(batch.column(3)):
                rows = batch.slice(at, len(part))
                at += len(part)
                yield self._documents(rows, part.to_pylist())
                if len(self.met) >= ROWS_AT_ONCE:
                    yield self._meetings()
                if len(self.counted) >= COUNTED_WORDS:
                    yield self._words()
        yield self._meetings()
        yield self._words()

    def _documents(self, rows: pa.RecordBatch, texts: list[str | None]) -> pa.RecordBatch:
        numbers = rows.column(0).to_pylist()
        out: dict[str, list] = {name: [] for name in (*(f"n_{k}" for k in KINDS), "base")}
        for no, text in zip(numbers, texts, strict=True):
            spans = base_spans(text) if text else []
            counts = Counter(kind for kind, _, _ in spans)
            for kind in KINDS:
                out[f"n_{kind}"].append(counts[kind])
            out["base"].append(",".join(f"{k}:{s}:{e}" for k, s, e in spans))
            if spans:
                self.met += [(no, *m) for m in meetings(text, spans)]
            if text:
                words: set[bytes] = set()
                for some in term_parts(text.encode()):
                    words.update(some)
                self.counted.update(words)
        return self._batch(no=rows.column(0), key=rows.column(1), doc_id=rows.column(2), **out)

    def _meetings(self) -> pa.RecordBatch:
        names = ("no", "entity", "word", "first", "context", "start", "end")
        columns = zip(*self.met, strict=True) if self.met else [()] * len(names)
        columns = dict(zip(names, map(list, columns), strict=True))
        self.met = []
        return self._batch(**columns)

    def _words(self) -> pa.RecordBatch:
        words = [w.decode("utf-8", "replace") for w in self.counted]
        docs = list(self.counted.values())
        self.counted = Counter()
        return self._batch(word=words, docs=docs)

    def _batch(self, **columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        arrays = []
        for field in self.schema:
            value = columns.get(field.name)
            if isinstance(value, pa.Array):
                arrays.append(value)
            else:
                arrays.append(pa.array(value, field.type) if value is not None else pa.nulls(n, field.type))
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def scan_private(docs: DataFrame) -> DataFrame:
    """One pass over all texts: what `_Scanner` gives. Write it before it is used."""
    share(docs.sparkSession, None)
    kind = docs.schema["doc_id"].dataType
    key = pa.struct([("a", pa.int64()), ("b", pa.int64())])
    head = [("no", pa.int64()), ("key", key), ("doc_id", to_arrow_type(kind))]
    fields = [*head, *FIELDS]
    schema = (
        f"no long, key struct<a:long,b:long>, doc_id {kind.simpleString()}, n_email long,"
        " n_ip long, n_card long, n_phone long, base string, entity string, word string,"
        " first int, context long, start long, end long, docs long"
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _Scanner(pa.schema(fields))(batches)

    numbered = docs.select(
        F.monotonically_increasing_id().alias("no"),
        row_key("doc_id", "text").alias("key"),
        "doc_id",
        "text",
    )
    return numbered.mapInArrow(scan, schema)


def disclosing_words(scanned: DataFrame) -> DataFrame:
    """`(entity, word, n_docs, n_entity, n_word, pmi, ic, kind)` of the words that give away."""
    total = scanned.where("base IS NOT NULL").count()
    met = scanned.where("entity IS NOT NULL")
    entities = met.where("word IS NULL").groupBy("entity").agg(F.sum("first").alias("n_entity"))
    pairs = met.where("word IS NOT NULL").groupBy("entity", "word")
    pairs = pairs.agg(F.sum("first").alias("n_docs"), F.countDistinct("context").alias("contexts"))
    pairs = cut_lineage(pairs.where(F.col("contexts") >= LEAST_CONTEXTS).drop("contexts"))
    few = broadcast_within_limit(pairs)
    words = scanned.where("docs IS NOT NULL").groupBy("word").agg(F.sum("docs").alias("n_word"))
    found = words.join(few, "word").join(entities, "entity")
    found = found.withColumn("ic", F.log2(F.lit(float(total)) / F.col("n_entity")))
    told = F.lit(float(total)) * F.col("n_docs") / (F.col("n_word") * F.col("n_entity"))
    found = found.withColumn("pmi", F.log2(told))
    told_all = F.col("pmi") >= REMOVE * F.col("ic")
    found = found.withColumn("kind", F.when(told_all, "remove").otherwise("generalise"))
    enough = (F.col("pmi") > 0) & (F.col("pmi") >= GENERALISE * F.col("ic"))
    names = ("entity", "word", "n_docs", "n_entity", "n_word", "pmi", "ic", "kind")
    return found.where(enough).select(*names)


def find_private(docs: DataFrame) -> DataFrame:
    """`(key, doc_id, n_email, n_ip, n_card, n_phone, base, spans)` of every row of `docs`.

    `base` and `spans` list `kind:start:end`, in code points, the end exclusive: `base` the
    personal data, by kind and start; `spans` those and then, likewise, the words that are
    to be generalised or removed. `key` is `row_key("doc_id", "text")`.
    """
    scanned = cut_lineage(scan_private(docs))
    telling = cut_lineage(disclosing_words(scanned).select("entity", "word", "kind"))
    met = scanned.where("entity IS NOT NULL AND word IS NOT NULL")
    places = met.join(broadcast_within_limit(telling), ["entity", "word"])
    # A word beside two entities is removed if either asks for it.
    places = places.groupBy("no", "start", "end").agg(F.max("kind").alias("kind"))
    span = F.concat_ws(":", "kind", "start", "end").alias("text")
    placed = F.struct("kind", "start", span)
    added = places.groupBy("no").agg(F.array_sort(F.collect_list(placed))["text"].alias("added"))
    rows = scanned.where("base IS NOT NULL").join(added, "no", "left")
    parts = F.concat(F.array(F.nullif("base", F.lit(""))), F.coalesce("added", F.array()))
    spans = F.concat_ws(",", parts).alias("spans")
    return rows.select("key", "doc_id", *(f"n_{k}" for k in KINDS), "base", spans)


def replace_spans(text: str | None, spans: str | None) -> str | None:
    """The text with its spans replaced by their kinds; removed words leave nothing.

    Where spans overlap, the first one names what they cover together.
    """
    if not text or not spans:
        return text
    places = []
    for span in spans.split(","):
        kind, start, end = span.split(":")
        places.append((int(start), -int(end), kind))
    out, at, label_to = [], 0, -1
    for start, end, kind in sorted(places):
        end = -end
        if start < label_to:
            at = label_to = max(label_to, end)
            continue
        out.append(text[at:start])
        out.append("" if kind == "remove" else "[WORD]" if kind == "generalise" else f"[{kind.upper()}]")
        at = label_to = end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, out: str = "clean") -> DataFrame:
    """`docs` with a column `out`: the text without personal data and what gives it away.

    A null text stays null. A column already named so is replaced.
    """
    share(docs.sparkSession, None)

    @F.arrow_udf("string")
    def without(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array(map(replace_spans, texts.to_pylist(), spans.to_pylist()), pa.string())

    key, spans = free_name(docs, "key"), free_name(docs, "spans")
    found = find_private(docs).where("spans <> ''")
    found = found.select(F.col("key").alias(key), F.col("spans").alias(spans)).dropDuplicates([key])
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    joined = keyed.join(broadcast_within_limit(cut_lineage(found)), key, "left")
    return joined.withColumn(out, without("text", spans)).drop(key, spans)
