"""A training corpus out of `documents`: five stages, each over all that the one before kept.

Every stage takes `(spark, docs, sf_dir)` and returns a table. All but the last keep the columns
of `docs`; the last returns the pieces of each text that is left. Columns other than `doc_id`,
`text` and `n_chars` are carried along, whatever their names and values. How nulls, empty and
repeated rows count is said by the operator of each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblens.llm import toxicity
from weblens.llm.common import KEY, free_name, read_table, row_key
from weblens.llm.decontaminate import contamination
from weblens.llm.jaccard_join import near_duplicates
from weblens.llm.line_dedup import dedup_lines
from weblens.llm.pieces import encode_pieces, read_model
from weblens.llm.queries import MODEL
from weblens.shared import broadcast_within_limit, cut_lineage


def named(docs: DataFrame) -> list:
    """The columns of `docs` in their order, whatever signs their names hold."""
    return [F.col(f"`{name}`") for name in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of `documents`, scores as toxic go."""
    model = toxicity.train_toxicity(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )
    score = free_name(docs, "toxicity")
    scored = toxicity.score_toxicity(docs, model, out=score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id has go; documents stay, also emptied ones."""
    kept = dedup_lines(docs, counts=None)
    if "n_chars" in kept.columns:
        kind = kept.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.char_length("text").cast(kind))
    return kept


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays.

    Rows that repeat that id stay with it, and rows without an id stay.
    """
    found = near_duplicates(docs)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(broadcast_within_limit(cut_lineage(gone)), "doc_id", "left_anti")
    return kept.select(named(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages beyond the contamination rule go."""
    found = contamination(docs, read_table(spark, sf_dir, "benchmark"))
    key = free_name(docs, "key")
    gone = cut_lineage(found.where("contaminated").select(F.col(KEY).alias(key)).distinct())
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    return keyed.join(broadcast_within_limit(gone), key, "left_anti").select(named(docs))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text's pieces, how many, and the text they decode to."""
    model = read_model(public_tokenizers.path(MODEL))
    coded = encode_pieces(docs.select("doc_id", "text"), model, decoded="decoded")
    count = F.size("piece_ids").cast("long").alias("n_pieces")
    return coded.select("doc_id", count, "piece_ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", to_pieces),
]

# Two stages rest on a trained classifier and on a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
