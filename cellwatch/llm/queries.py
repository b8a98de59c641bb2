"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.llm import (
    bpe,
    conversation_repair,
    exact_dedup,
    fill_in_middle,
    language_id,
    lm_scoring,
    ngram_join,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    token_counts,
    winnowing,
)
from cellwatch.llm.common import written
from cellwatch.sources.tables import read_table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document in the graph of near duplicates."""
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-or-drop decision of exact deduplication for every document."""
    return exact_dedup.deduplicate(read_table(spark, sf_dir, "documents"))


def _tokenizer(name: str) -> str:
    """Path of a public tokenizer file on the driver."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document in the byte-level vocabulary."""
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by co-trained content and metadata views; kept where it is good."""
    scored = quality_classifier.co_train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.withColumn("kept", F.col("quality_pred") == 1)


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    path = _tokenizer("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(read_table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of at most 2048 tokens."""
    cut = packing.pieces(read_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    return packing.place(written(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")),
                                 "pieces"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the hierarchical Pitman-Yor model."""
    return lm_scoring.score(read_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and log-ratio verdict of every document; documents labelled good are the target."""
    docs = read_table(spark, sf_dir, "documents")
    good = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    # The labels grow with the documents, so they are never broadcast.
    target = docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left_semi")
    return quality_rules.quality_rules(docs, target)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts of the fixed patterns, all spans as text."""
    found = pii.find(read_table(spark, sf_dir, "documents"))
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation and its cheapest repair."""
    damaged = conversation_repair.damage(read_table(spark, sf_dir, "conversations"))
    return conversation_repair.summarise(damaged)


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprint of every document, beside those of its edited text and the next document."""
    found = winnowing.neighbour_likeness(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", winnowing.as_text("hashes", "positions").alias("fingerprint"),
                        winnowing.as_text("edited_hashes", "edited_positions").alias("edited_fingerprint"),
                        "near_edited", "near_next")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of every document, as digests of the output and of the text rebuilt from it."""
    made = fill_in_middle.fill_in_middle(read_table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_in_middle.restored("output", "form"), 256).alias("restored_sha256"))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_language_id": op6_language_id,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_quality_rules": op9_quality_rules,
    "op10_pii": op10_pii,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLES = {
    "op1_ngram_jaccard_join": ngram_join.ORACLE,
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op13_fill_in_middle": fill_in_middle.ORACLE,
}
