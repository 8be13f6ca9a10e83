"""A corpus from raw documents: quality rules, near duplicates, secrets, source mix, token ids.

Every stage works on all rows that the one before it kept, with production parameters. Stages
are written and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialstats.llm import bpe, catalog, jaccard, mixing, quality, secrets
from trialstats.llm.common import documents, settle, text_key

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules of their language and source."""
    return quality.judge(docs).where("kept").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard.one_per_class(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in the text and ``n_chars`` as it is then."""
    changed = {
        "text": "redacted",
        "n_chars": "IF(size(secrets) > 0, CAST(char_length(redacted) AS bigint), row.n_chars)",
    }
    return secrets.scan(docs).selectExpr(*[f"{changed.get(c, f'row.`{c}`')} AS `{c}`" for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: its row is absent, there once, or repeated."""
    return mixing.mixed_rows(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every row: ``(doc_id, lang, source, n_tokens, ids)``."""
    encoded = bpe.encode_texts(docs, catalog.TOKENIZER)
    keyed = docs.select("doc_id", "lang", "source", text_key(F.coalesce("text", F.lit(""))).alias("key"))
    return keyed.join(encoded, "key").select(
        "doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
    ("encode", encode_texts),
]

# Encoding has no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
