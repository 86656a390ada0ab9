"""The corpus pipeline: every stage takes all documents its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from platelake.llm import dart_minhash, decontaminate, language_id, packing, quality_rules
from platelake.llm.shared import stored, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the adaptive quality rules. A NULL or empty text has no words and goes; a table too small for limits is held
    to the base rules only."""
    return quality_rules.keep_good(docs)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain. A text without a letter has none and goes."""
    return language_id.keep_known(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates. Groups are of texts, so rows that share or lack an id are told apart by their text."""
    return dart_minhash.keep_first(docs)


def unseen_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark of five words or more; an empty benchmark removes nothing, and rows without an id stay."""
    return decontaminate.keep_unseen(docs, table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces in sequences; an empty text is one piece, its end."""
    return packing.packed(docs, TOKENIZER)


STAGES = [
    ("quality_rules", good_quality),
    ("language_id", known_language),
    ("near_dedup", one_of_each),
    ("decontamination", unseen_items),
    ("packing", packed_sequences),
]

#: Models and hashed signatures have no SQL counterpart; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
