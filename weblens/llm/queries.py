"""The registered queries of this folder's operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblens.llm import quality, toxicity
from weblens.llm.alignment import align_tokens
from weblens.llm.common import read_table
from weblens.llm.decontaminate import contamination
from weblens.llm.disclosure import find_private
from weblens.llm.divergence import source_divergence
from weblens.llm.folds import held_out
from weblens.llm.jaccard_join import near_duplicates
from weblens.llm.licences import scan_licences
from weblens.llm.line_dedup import dedup_lines
from weblens.llm.oracle import ORACLE
from weblens.llm.pieces import encode_pieces, read_model
from weblens.llm.token_counts import count_tokens
from weblens.llm.top_k import top_k
from weblens.llm.warc import archive_and_read_back

__all__ = ["ORACLE", "QUERIES"]

MODEL = "piece_bpe_32k.model"
TOKENIZER = "byte_bpe_50k.json"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document's pieces, and the text they decode to."""
    model = read_model(public_tokenizers.path(MODEL))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_pieces(docs, model, decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        "piece_ids",
        "decoded",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_and_read_back(read_table(spark, sf_dir, "pages"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = read_model(public_tokenizers.path(MODEL))
    return count_tokens(read_table(spark, sf_dir, "documents"), model)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return contamination(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licences(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.concat_ws(",", "sentences").alias("sentence_ids"),
        F.concat_ws(",", "licences").alias("licences"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def classified(
    spark: SparkSession, sf_dir: str, train: Callable, score: Callable, threshold: float
) -> DataFrame:
    """Learn from labels that are not held out, then score every whole text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(
        spark, sf_dir, quality.train_quality, quality.score_quality, quality.THRESHOLD
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(
        spark, sf_dir, toxicity.train_toxicity, toxicity.score_toxicity, toxicity.THRESHOLD
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = read_model(public_tokenizers.path(TOKENIZER))
    model = read_model(public_tokenizers.path(MODEL))
    return align_tokens(read_table(spark, sf_dir, "documents"), tokenizer, model)[0]


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(read_table(spark, sf_dir, "documents"))
    counts = ("n_email", "n_ip", "n_card", "n_phone")
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = source_divergence(read_table(spark, sf_dir, "documents"))
    return found.select("lang", "source", "part", "item", "value", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_warc": op2_warc,
    "op3_token_counts": op3_token_counts,
    "op4_decontamination": op4_decontamination,
    "op5_top_k": op5_top_k,
    "op6_licences": op6_licences,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_alignment": op11_alignment,
    "op12_pii": op12_pii,
    "op13_divergence": op13_divergence,
}
