"""One registered query for each operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barmart.llm import (
    bpe,
    curriculum_mix,
    html_extraction,
    jaccard_join,
    language_id,
    prefix_trie,
    quality_rules,
    spelling_variants,
    substring_dedup,
    token_counts,
    topk_search,
    toxicity,
    url_filter,
)
from barmart.llm.oracles import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_table(spark, sf_dir))


def links_of_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_pairs(_table(spark, sf_dir))


def link_counts_of_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_counts(_table(spark, sf_dir))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.self_search(_table(spark, sf_dir, "embeddings"))


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum_mix.mix_digests(_table(spark, sf_dir))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(_table(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_scores(_table(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_digests(_table(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(_table(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(_table(spark, sf_dir))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(_table(spark, sf_dir, "pages"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_jaccard_join,
        links_of_jaccard_join,
        link_counts_of_jaccard_join,
        op2_topk_search,
        op3_curriculum_mix,
        op4_url_filter,
        op5_quality_rules,
        op6_toxicity,
        op7_substring_dedup,
        op8_token_counts,
        op9_language_id,
        op10_bpe,
        op11_spelling_variants,
        op12_html_extraction,
        op13_prefix_trie,
    )
}
