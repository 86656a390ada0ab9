"""The registered queries of this subpackage: each takes ``(spark, sf_dir)`` and covers its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.llm import (
    bit_packing,
    cross_entropy,
    dart_minhash,
    decontaminate,
    filter_audit,
    importance,
    kneser_ney,
    language_id,
    mixing,
    oracle,
    packing,
    quality_rules,
    toxicity,
    url_filter,
)
from platelake.llm.shared import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
VOCABULARY = 49_408
RULES = (
    (url_filter.ALLOW, "com/"),
    (url_filter.BLOCK, "example.com/en/"),
    (url_filter.ALLOW, "www.example.com/en/"),
    (url_filter.BLOCK, "net/es/"),
    (url_filter.BLOCK, "net/fr/"),
)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def _trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents labelled as good."""
    return table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op2_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy.scores(table(spark, sf_dir, "documents"), _trusted(spark, sf_dir))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.perplexities(table(spark, sf_dir, "documents"), _trusted(spark, sf_dir))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.duplicate_classes(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs that some page was reached at with a referrer."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    referred = pages.filter(F.col("url").rlike(r"[?&]ref="))
    return url_filter.judged(pages, referred.select(url_filter.canonical(F.col("url")).alias("url")), RULES)


def op8_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = bit_packing.written(table(spark, sf_dir, "documents"), TOKENIZER, VOCABULARY)
    return bit_packing.read_documents(images)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_cross_entropy,
        op3_decontamination,
        op4_kneser_ney,
        op5_best_fit_packing,
        op6_dart_minhash,
        op7_url_filter,
        op8_bit_packing,
        op9_toxicity,
        op10_language_id,
        op11_mixing,
        op12_importance,
        op13_filter_audit,
    )
}
LLM_SQL: dict[str, str] = {
    "op1_quality_rules": oracle.QUALITY_RULES,
    "op3_decontamination": oracle.DECONTAMINATION,
    "op7_url_filter": oracle.URL_FILTER,
    "op11_mixing": oracle.MIXING,
    "op13_filter_audit": oracle.FILTER_AUDIT,
}
