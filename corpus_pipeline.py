"""Training-data pipeline: language, exact and near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; its
result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.llm import exact_dedup, language_id, ngram_join, packing, pii
from cellwatch.llm.common import written
from cellwatch.sources.tables import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; those without a letter go. Learned from the labelled rows."""
    return language_id.keep_identified(docs, language_id.train(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every text (equal up to white space)."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return ngram_join.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of at most 2048 tokens."""
    import public_tokenizers
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.place(written(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")),
                                 "pieces"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

# Language identification, contextual extraction and packing have no SQL form: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
