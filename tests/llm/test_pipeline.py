"""The pipeline's stages on small tables: what goes, what stays, and odd rows."""

from ast import literal_eval

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_decontaminate import words
from tests.llm.test_jaccard_join import brute as brute_groups
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_pieces import LIBRARY
from weblens.llm.decontaminate import contamination
from weblens.llm.jaccard_join import near_duplicates
from weblens.llm.line_dedup import dedup_lines
from weblens.shared import cut_lineage

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(cut_lineage(stage(spark, docs[-1], SF_DIR)))
    return docs


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_each_stage_does_its_work(spark, stages):
    start, clean, lines, single, fair, coded = stages
    assert all(df.columns == start.columns for df in stages[1:5])
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").join(start, "doc_id")
    not_toxic = ids(labels.where("toxic = 0"))
    assert len(ids(clean) & not_toxic) >= 0.97 * len(not_toxic)
    assert len(ids(labels.where("toxic = 1")) - ids(clean)) > len(ids(clean) & ids(labels.where("toxic = 1")))

    want = {r.doc_id: r.text for r in dedup_lines(clean).collect()}
    assert {r.doc_id: r.text for r in lines.collect()} == want
    assert lines.where(F.char_length("text") != F.col("n_chars")).isEmpty()

    groups = {r.component_id for r in near_duplicates(lines).collect()}
    assert ids(single) == groups

    found = contamination(single, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
    assert ids(fair) == ids(found.where("NOT contaminated")) < ids(single)

    texts = {r.doc_id: r.text for r in fair.collect()}
    assert {r.doc_id: r.decoded for r in coded.collect()} == texts


def test_odd_rows_pass_every_stage(spark):
    rows = [(None, None, None), (None, "x", 1), (1, "", 0), (1, "", 0), (2, None, None), (3, "long " * 20000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    docs = docs.selectExpr("*", "'a' AS score", "'b' AS component_id", "1 AS `odd.name`")
    # Names that the stages and their operators use themselves.
    own = ["__row_key", "key", "gone", "LINES", "__gone", "__lines", "__toxicity", "toxicity", "coded", "__coded", "__at"]
    docs = docs.selectExpr("*", *[f"'{name}' AS `{name}`" for name in own])
    for name, stage in corpus_pipeline.STAGES:
        for some in (docs, docs.limit(0)):
            out = stage(spark, some, SF_DIR)
            assert out.count() == some.count(), name
            if name != "sentencepiece":
                assert out.where(" OR ".join(f"`{n}` <> '{n}'" for n in own)).count() == 0
                assert out.columns == docs.columns and out.schema["n_chars"].dataType.simpleString() == "int"


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def contaminated(docs, items, window=13):
    """The rule of `test_decontaminate.brute`, with the phrases looked up."""
    phrases = set()
    for _, text in items:
        w = words(text)
        phrases |= {tuple(w[s : s + window]) for s in range(max(len(w) - window, 0) + 1 if w else 0)}
    sizes = {len(p) for p in phrases}
    for i, text in docs:
        w = words(text)
        hit = set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in phrases:
                    hit.update(range(s, s + n))
        if hit and 20 * len(hit) >= len(w):
            yield i


def test_stages_against_brute_force(spark, stages):
    _, clean, lines, single, fair, coded = stages
    want = sorted((i, text) for i, _, _, text in map(literal_eval, brute_lines(pairs(clean))))
    assert sorted(pairs(lines)) == want

    groups = {literal_eval(r)[2] for r in brute_groups(pairs(lines))}
    assert sorted(pairs(single)) == [(i, text) for i, text in want if i in groups]

    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    gone = set(contaminated(pairs(single), items))
    assert gone and sorted(pairs(fair)) == sorted(r for r in pairs(single) if r[0] not in gone)

    got = sorted((r.doc_id, r.n_pieces, r.piece_ids) for r in coded.collect())
    coding = [(i, LIBRARY.encode(text)) for i, text in sorted(pairs(fair))]
    assert got == [(i, len(pieces), pieces) for i, pieces in coding]
