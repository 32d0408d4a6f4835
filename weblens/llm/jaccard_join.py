"""Link texts whose shingle sets have a Jaccard similarity of at least 0.8, exactly.

Equal sets are one class; only a class's first document takes part in what follows. Each set
is a node, named by its document's id, or by a number of its own where an id has several.

A linked pair shares at least t of the values that both sets hold among their smallest ones
(all values for t the whole overlap that 0.8 asks for). So linked sets occur together in at
least t inverted lists, and DivideSkip finds them:

- Short lists are merged: sorted by value, each gives its pairs, and pairs are counted.
- Long lists (over `LIST_MOST` documents) are not merged. A set in L long lists needs only
  t - L short ones in common with its partner. Long lists are probed instead: the candidates
  that are left are compared by binary search in their whole sorted sets.
- A pair can be missed so only if both sets have t or more long lists. Those sets go through
  the same again with their whole sets, where t is largest; what is dense even then (large
  groups of near copies, texts made of common passages) is linked to pivots first, and then
  every set outside the largest component is searched for in blocks of the others, each block
  with lists of its own that are merged or probed by the same rule.

A long list reaches no task as a whole: where one batch has more than `LIST_MOST` documents
of a value it sends one mark instead of them, and the task that meets a mark or more rows only
counts them by document. Candidate pairs are compared in two steps, first the best of each
document, then only pairs that are not connected by then.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from weblens.llm.common import batch_of, share
from weblens.llm.components import components
from weblens.llm.hashed_words import mix, row_slices
from weblens.llm.shingles import common, digest, shingle_sets
from weblens.shared import broadcast_within_limit, cut_lineage

PERCENT = 80
SHARE = 0.1  # of a set's size: lists in which linked sets must meet, in the first pass
LIST_MOST = 32
BLOCK = 4096
PIVOTS = 8

SET = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64())]
    + [("shingles", pa.binary())]
)
ENTRY = pa.schema([("value", pa.int64()), ("node", pa.int64()), ("kind", pa.int64())])
MET = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("met", pa.int64())])
LINK = pa.schema([("x", pa.int64()), ("y", pa.int64())])
MARK, OF_LIST = -1, 0  # kinds of entries; above 0: how many long lists a node is in


def at_least(n):
    """The overlap that a set of `n` needs with any set that it links with."""
    return -(-PERCENT * n // 100)


def first_pass(n: int) -> int:
    return math.ceil(SHARE * n)


def to_sets(docs: DataFrame, doc_id: str, text: str, whole: bool) -> DataFrame:
    """`SET` of every row; of the shingles all, or those the first pass needs."""
    share(docs.sparkSession, None)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = iter(batch[0].to_pylist())
            for part in row_slices(batch[1]):
                rows = []
                for found in shingle_sets(part):
                    n = len(found)
                    most = n if whole else n - at_least(n) + first_pass(n)
                    rows.append((next(ids), n, *digest(found), found[:most].tobytes()))
                yield batch_of(rows, SET)

    rows = docs.select(F.col(doc_id).cast("long"), F.col(text))
    return rows.mapInArrow(hashed, from_arrow_schema(SET))


# --- inverted lists


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return begins, np.diff(np.r_[begins, len(values)])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = batch["node"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.int64) for x in batch["shingles"]]
        if not sets:
            continue
        values = np.concatenate(sets)
        owners = np.repeat(nodes, [len(s) for s in sets])
        order = np.argsort(values, kind="stable")
        values, owners = values[order], owners[order]
        begins, sizes = _runs(values)
        long = np.repeat(sizes > LIST_MOST, sizes)
        marks = values[begins[sizes > LIST_MOST]]
        held, times = np.unique(owners[long], return_counts=True)
        columns = [
            np.concatenate([values[~long], marks, held]),
            np.concatenate([owners[~long], np.zeros(len(marks), np.int64), held]),
            np.concatenate([np.full((~long).sum(), OF_LIST), np.full(len(marks), MARK), times]),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=ENTRY)


def _pairs(nodes: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All pairs within each run, as two rows."""
    found = [np.zeros((2, 0), np.int64)]
    for size in np.unique(sizes[sizes > 1]):
        lists = nodes[begins[sizes == size][:, None] + np.arange(size)]
        i, j = np.triu_indices(int(size), 1)
        found.append(np.stack([lists[:, i].ravel(), lists[:, j].ravel()]))
    pairs = np.sort(np.concatenate(found, 1), 0)
    return pairs[:, pairs[0] != pairs[1]]


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of entries sorted by value: how often pairs meet in short lists, and, with `y` null,
    in how many long lists a node is."""

    def told(values, nodes, kinds):
        begins, sizes = _runs(values)
        marked = np.zeros(len(begins), bool)
        lists = kinds == OF_LIST
        run_of = np.repeat(np.arange(len(begins)), sizes)
        marked[run_of[kinds == MARK]] = True
        listed = np.bincount(run_of[lists], minlength=len(begins))
        is_long = marked | (listed > LIST_MOST)
        keep = lists & ~is_long[run_of]
        short_begins, short_sizes = _runs(values[keep])
        pairs = _pairs(nodes[keep], short_begins, short_sizes)
        both, times = np.unique(pairs, axis=1, return_counts=True)
        long = lists & is_long[run_of]
        held = np.concatenate([nodes[long], nodes[kinds > 0]])
        weights = np.concatenate([np.ones(long.sum(), np.int64), kinds[kinds > 0]])
        who, at = np.unique(held, return_inverse=True)
        total = np.bincount(at, weights, len(who)).astype(np.int64)
        columns = [
            pa.array(np.concatenate([both[0], who])),
            pa.concat_arrays([pa.array(both[1], pa.int64()), pa.nulls(len(who), pa.int64())]),
            pa.array(np.concatenate([times, total])),
        ]
        last_long = bool(len(is_long) and is_long[-1])
        return pa.RecordBatch.from_arrays(columns, schema=MET), last_long

    rest = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        columns = [
            np.concatenate([r, c.to_numpy(zero_copy_only=False)])
            for r, c in zip(rest, batch.columns, strict=True)
        ]
        values, _, kinds = columns
        if not len(values):
            continue
        # The last list may go on in the next batch: it waits, or only its mark if it is long.
        cut = int(np.searchsorted(values, values[-1]))
        tail = [c[cut:] for c in columns]
        if (tail[2] == MARK).any() or (tail[2] == OF_LIST).sum() > LIST_MOST:
            yield told(*columns)[0]
            rest = [values[-1:], np.zeros(1, np.int64), np.full(1, MARK)]
        else:
            yield told(*[c[:cut] for c in columns])[0]
            rest = tail
    yield told(*rest)[0]


def meetings(sets: DataFrame) -> DataFrame:
    """`MET` of `(node, shingles)`, summed: the short lists merged, the long ones counted."""
    entries = sets.select("node", "shingles").mapInArrow(_entries, from_arrow_schema(ENTRY))
    by_value = entries.repartition("value").sortWithinPartitions("value", "kind")
    met = by_value.mapInArrow(_met, from_arrow_schema(MET))
    return cut_lineage(met.groupBy("x", "y").agg(F.sum("met").alias("met")))


def candidates(met: DataFrame, sizes: DataFrame, whole: bool) -> tuple[DataFrame, DataFrame]:
    """Pairs that may link, and the nodes that have too many long lists for this pass."""
    long = met.where("y IS NULL").select(F.col("x").alias("node"), F.col("met").alias("long"))
    nodes = sizes.select("node", "n").join(long, "node", "left").fillna(0, ["long"])
    needs = at_least_column("n")
    if not whole:  # a partner may be smaller and then have this many lists
        needs = F.ceil(SHARE * needs)
    dense = nodes.where((F.col("long") > 0) & (F.col("long") >= needs)).select("node")
    sides = {
        s: nodes.select(
            F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("long").alias(f"long{s}")
        )
        for s in "xy"
    }
    pairs = met.where("y IS NOT NULL").join(sides["x"], "x").join(sides["y"], "y")
    small, large = F.least("nx", "ny"), F.greatest("nx", "ny")
    if whole:  # o / (nx + ny - o) >= p / 100
        lists = F.ceil(PERCENT * (F.col("nx") + F.col("ny")) / (100 + PERCENT))
    else:
        lists = F.ceil(SHARE * small)
    fits = (100 * small >= PERCENT * large) & (F.col("met") >= lists - F.least("longx", "longy"))
    return pairs.where(fits).select("x", "y", "met"), dense


def at_least_column(n: str):
    return F.ceil(PERCENT * F.col(n) / 100)


# --- comparing pairs


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        columns = (c.to_pylist() for c in batch.columns)
        for x, y, of_x, of_y in zip(*columns, strict=True):
            a, b = np.frombuffer(of_x, np.uint64), np.frombuffer(of_y, np.uint64)
            both = common(a, b)
            if 100 * both >= PERCENT * (len(a) + len(b) - both):
                rows.append((x, y))
        yield batch_of(rows, LINK)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs `(x, y)` whose whole sets link."""
    sides = {
        s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"of_{s}")) for s in "xy"
    }
    joined = pairs.select("x", "y").join(sides["x"], "x").join(sides["y"], "y")
    linked = joined.select("x", "y", "of_x", "of_y").mapInArrow(_links, from_arrow_schema(LINK))
    return cut_lineage(linked)


def best_pairs(pairs: DataFrame) -> DataFrame:
    """For each node its pair with the most meetings."""
    turned = pairs.select(F.col("y").alias("x"), F.col("x").alias("y"), "met")
    best = (
        pairs.unionByName(turned)
        .groupBy("x")
        .agg(F.max(F.struct("met", -F.col("y"), "y")).alias("best"))
    )
    other = F.col("best")["y"]
    return best.select(F.least("x", other).alias("x"), F.greatest("x", other).alias("y")).distinct()


def unconnected(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose nodes do not have one label."""
    for s in "xy":
        side = labels.select(F.col("node").alias(s), F.col("label").alias(f"label_{s}"))
        pairs = pairs.join(side, s, "left")
    same = F.coalesce("label_x", "x") == F.coalesce("label_y", "y")
    return pairs.where(~same).drop("label_x", "label_y")


# --- dense sets


def pivot_pairs(sets: DataFrame) -> DataFrame:
    """Pairs of a node with the first node that has the same smallest value, under some hashes."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, raw in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                values = np.frombuffer(raw, np.uint64)
                for k in range(PIVOTS):
                    low = mix(values + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))).min()
                    rows.append((node, k, int(low.view(np.int64))))
            yield batch_of(rows, SMALLEST)

    low = cut_lineage(
        sets.select("node", "shingles").mapInArrow(smallest, from_arrow_schema(SMALLEST))
    )
    firsts = low.groupBy("k", "low").agg(F.min("node").alias("x"), F.count("*").alias("c"))
    firsts = cut_lineage(firsts)
    pairs = low.join(firsts.where("c > 1"), ["k", "low"]).select("x", F.col("node").alias("y"))
    return pairs.where("x <> y").distinct()


SMALLEST = pa.schema([("node", pa.int64()), ("k", pa.int64()), ("low", pa.int64())])


def divide_skip(
    values: np.ndarray, lists: list[np.ndarray], need: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids that occur in at least `need` of sorted lists, and in how many.

    The longest lists, fewer than `need`, are set aside; the others are merged, and what occurs
    often enough there is looked up in the long ones by binary search.
    """
    lists = sorted((x for x in lists if len(x)), key=len)
    if len(lists) < need:
        return values[:0], values[:0]
    aside = min(need - 1, int(need / (0.01 * math.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    ids, times = np.unique(np.concatenate(short), return_counts=True)
    ids, times = ids[times >= need - aside], times[times >= need - aside]
    for x in long:
        at = np.searchsorted(x, ids)
        at[at == len(x)] = 0
        times = times + (x[at] == ids)
    return ids[times >= need], times[times >= need]


def _search(key, queries: pa.Table, block: pa.Table) -> pa.Table:
    """Links of each query with sets of one block that have another label."""
    rows = []
    if queries.num_rows and block.num_rows:
        nodes, labels = (block[c].to_numpy() for c in ("node", "label"))
        sets = [np.frombuffer(x, np.uint64) for x in block["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        values = np.concatenate(sets)
        owners = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(values, kind="stable")
        values, owners = values[order], owners[order]
        begins, lengths = _runs(values)
        heads = values[begins]
        least = np.minimum.reduceat(labels[owners], begins)
        most = np.maximum.reduceat(labels[owners], begins)
        for row in queries.to_pylist():
            own = np.frombuffer(row["shingles"], np.uint64)
            at = np.searchsorted(heads, own)
            at[at == len(heads)] = 0
            at = at[heads[at] == own]
            # Lists of the query's own component only have nothing to add.
            at = at[(least[at] != row["label"]) | (most[at] != row["label"])]
            lists = [owners[b : b + n] for b, n in zip(begins[at], lengths[at], strict=True)]
            ids, both = divide_skip(owners, lists, at_least(len(own)))
            linked = 100 * both >= PERCENT * (len(own) + sizes[ids] - both)
            linked &= labels[ids] != row["label"]
            rows.extend((row["node"], int(y)) for y in nodes[ids[linked]])
    return pa.Table.from_batches([batch_of(rows, LINK)])


def dense_links(sets: DataFrame, linked: DataFrame) -> DataFrame:
    """All links that still connect components among dense sets, and links to pivots."""
    starred = linked.unionByName(verified(pivot_pairs(sets), sets))
    labels = components(starred)
    marked = sets.join(labels, "node", "left")
    label = F.coalesce("label", "node").alias("label")
    marked = cut_lineage(
        marked.select("node", "shingles", label, F.xxhash64("node").alias("mixed"))
    )
    largest = marked.groupBy("label").count().orderBy(F.desc("count"), "label").select("label")
    queries = cut_lineage(marked.join(F.broadcast(largest.limit(1)), "label", "left_anti"))
    count, asked = marked.count(), queries.count()
    if not asked:
        return starred
    blocks, groups = math.ceil(count / BLOCK), math.ceil(asked / BLOCK)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = marked.withColumn("block", F.pmod("mixed", F.lit(blocks)).cast("int"))
    index = index.withColumn("part", each(groups)).groupBy("block", "part")
    asking = queries.withColumn("part", F.pmod("mixed", F.lit(groups)).cast("int"))
    asking = asking.withColumn("block", each(blocks)).groupBy("block", "part")
    found = asking.cogroup(index).applyInArrow(_search, from_arrow_schema(LINK))
    return starred.unionByName(cut_lineage(found))


# --- the join


def sets_of_many(live: DataFrame, of_class: DataFrame) -> DataFrame:
    """`(doc_id, a, b, n, first, node)`: the sets of ids that have several.

    `first` is the first id of a set's class. The node, a number that is no id, is null where
    another id is the first.
    """
    key = ("n", "a", "b")
    ends = [f(c).alias(f"{at}_{c}") for c in key for at, f in (("low", F.min), ("high", F.max))]
    several = " OR ".join(f"low_{c} <> high_{c}" for c in key)
    ids = cut_lineage(live.groupBy("doc_id").agg(*ends).where(several).select("doc_id"))
    first = F.coalesce("first", "doc_id").alias("first")
    sets = of_class.join(broadcast_within_limit(ids), "doc_id", "left_semi")
    sets = cut_lineage(sets.select("doc_id", "a", "b", "n", first).distinct())
    for k in itertools.count():
        number = F.xxhash64(F.lit(k), "doc_id", "a", "b", "n")
        many = sets.withColumn("node", F.when(F.col("first") == F.col("doc_id"), number))
        nodes = many.select("node").dropna()
        if nodes.isEmpty():
            return many
        taken = live.select(F.col("doc_id").alias("node")).join(
            broadcast_within_limit(cut_lineage(nodes)), "node", "left_semi"
        )
        if taken.isEmpty() and nodes.groupBy("node").count().where("count > 1").isEmpty():
            return many


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, n_shingles, component_id)` for every row of `docs`.

    `component_id` is the smallest id reachable by links, the row's own included. Null and
    empty texts have no shingles and link with nothing. Rows with equal ids are one document,
    which links if any of its texts does. A row without an id has its size, links with
    nothing and has no component. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = cut_lineage(to_sets(rows, "doc_id", "text", whole=False))
    live = sets.where("n > 0 AND doc_id IS NOT NULL")
    shared = live.groupBy("a", "b", "n").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("c")
    )
    # A row per class of copies; a class may have a third of all rows.
    copied = cut_lineage(shared.where("c > 1").select("a", "b", "n", "first"))
    of_class = live.join(broadcast_within_limit(copied), ["a", "b", "n"], "left")
    first = F.coalesce("first", "doc_id")
    many = cut_lineage(sets_of_many(live, of_class))
    named = broadcast_within_limit(
        cut_lineage(many.select("doc_id", "a", "b", "n", "node", F.lit(True).alias("own")))
    )
    node = F.when(F.col("own"), F.col("node")).otherwise(F.col("doc_id")).alias("node")
    nodes = of_class.where(F.col("doc_id") == first).join(named, ["doc_id", "a", "b", "n"], "left")
    nodes = nodes.select(node, "n", "a", "b", "shingles")
    sizes = nodes.groupBy("node").agg(F.max("n").alias("n"))
    sizes = cut_lineage(sizes)

    pairs, dense = candidates(meetings(nodes), sizes, whole=False)
    pairs, dense = cut_lineage(pairs), cut_lineage(dense)
    ends = pairs.select(F.explode(F.array("x", "y")).alias("node"))
    needed = cut_lineage(ends.unionByName(dense).distinct())
    numbers = many.where("node IS NOT NULL").select("node", F.col("doc_id").alias("of_id"))
    numbers = broadcast_within_limit(cut_lineage(numbers))
    ids = needed.join(numbers, "node", "left").select(F.coalesce("of_id", "node").alias("doc_id"))
    kept = rows.join(broadcast_within_limit(cut_lineage(ids.distinct())), "doc_id", "left_semi")
    whole = to_sets(kept, "doc_id", "text", whole=True).where("n > 0")
    whole = whole.dropDuplicates(["doc_id", "a", "b"]).join(named, ["doc_id", "a", "b", "n"], "left")
    whole = cut_lineage(whole.select(node, "n", "shingles").where("node IS NOT NULL"))
    dense_sets = whole.join(broadcast_within_limit(dense), "node", "left_semi")
    more, denser = candidates(meetings(dense_sets), sizes, whole=True)
    pairs = cut_lineage(pairs.unionByName(more))
    denser = cut_lineage(denser)

    best = cut_lineage(best_pairs(pairs))
    linked = verified(best, whole)
    left = unconnected(pairs, components(linked)).select("x", "y").distinct()
    left = left.join(best, ["x", "y"], "left_anti")
    linked = linked.unionByName(verified(left, whole))
    if not denser.isEmpty():
        densest = cut_lineage(whole.join(broadcast_within_limit(denser), "node", "left_semi"))
        linked = dense_links(densest, linked)
    # Texts of one id are one document, whatever class each is in.
    for side in "xy":
        of_side = numbers.withColumnRenamed("node", side)
        linked = linked.join(of_side, side, "left").withColumn(side, F.coalesce("of_id", side))
        linked = linked.drop("of_id")
    joined = many.where("first <> doc_id").select(F.col("first").alias("x"), F.col("doc_id").alias("y"))
    linked = linked.select("x", "y").unionByName(joined.distinct()).where("x <> y")
    labels = components(cut_lineage(linked))

    of_copies = copied.join(labels, copied["first"] == labels["node"], "left").select(
        "a", "b", "n", F.coalesce("label", "first").alias("of_class")
    )
    own = labels.select(F.col("node").alias("doc_id"), F.col("label").alias("own"))
    return (
        sets.select("doc_id", "n", "a", "b")
        .join(broadcast_within_limit(cut_lineage(of_copies)), ["a", "b", "n"], "left")
        .join(own, "doc_id", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNull(), None)
            .otherwise(F.coalesce("own", "of_class", "doc_id"))
            .alias("component_id"),
        )
    )
