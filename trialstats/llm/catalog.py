"""Queries of the training-data operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trialstats.llm import (
    ann, bpe, collocations, jaccard, language_id, lm, mixing, oracle, packing, quality, secrets, sharding, spelling, token_counts,
)
from trialstats.llm.common import documents, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.document_digests(documents(spark, sf_dir), TOKENIZER)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.suffix_sums(token_counts.length_histogram(documents(spark, sf_dir), TOKENIZER))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(documents(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(documents(spark, sf_dir), count=8)


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(documents(spark, sf_dir))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.document_classes(documents(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(documents(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(documents(spark, sf_dir))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.document_variants(documents(spark, sf_dir))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(documents(spark, sf_dir), TOKENIZER)


_QUERIES = [
    op1_bpe, op2_language_id, op3_token_counts, op4_lm, op5_sharding, op6_ann, op7_secrets, op8_ngram_jaccard, op9_mixing,
    op10_quality, op11_spelling, op12_collocations, op13_packing,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of this subpackage by name."""
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express."""
    return oracle.oracle_sql()
