"""A training-data pipeline over the table documents: quality, near duplicates, repeated passages, mixing, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barmart.llm import bpe, curriculum_mix, jaccard_join, quality_rules, substring_dedup
from barmart.llm.shared import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.without_rejected(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each class of near duplicates."""
    return jaccard_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that 35-word windows found elsewhere cover."""
    return substring_dedup.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the curriculum takes them, in training order."""
    return curriculum_mix.training_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the token ids of the text."""
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.json"), ("doc_id", "lang", "source"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix", mix),
    ("encode", encode),
]

#: Outliers, classes and encodings are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written to the shared folder and reread by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
