"""Exact token counts of a corpus for every context limit, from its length histogram.

Documents are counted per encoded length, with copies of a text and partial counts combined
before the shuffle. Sums over the longer lengths then answer, for every limit, how many
documents reach it and how many tokens are left after truncation. The histogram has a row
per distinct length, whatever the number of documents; running sums go over blocks of lengths.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialstats.llm.bpe import codec
from trialstats.llm.common import by_batch, settle

# Lengths in a block of the running sums.
BLOCK = 1024


def encoded_lengths(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``n_tokens`` of every row; a null or empty text has 0."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path)
        lengths = [len(c.encode(t)) if t else 0 for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["n_tokens"])

    return df.select(F.col(text).cast("string").alias("text")).mapInArrow(by_batch(run), "n_tokens bigint")


def length_histogram(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``(n_tokens, n_docs)`` over all rows.

    Repeated rows count as often as they are there, texts of any length are encoded whole, null and
    empty ones have length 0, and an empty table gives no rows.
    """
    return encoded_lengths(df, path, text).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """One row per distinct length, which answers for the limit of that length.

    ``docs_at_least`` and ``tokens_at_least`` cover the documents of this length or more,
    ``truncated_tokens`` is what remains when every document is cut to this length, and
    ``share_below`` .. ``share_to`` is the range of quantiles that this length is the value of.
    An empty corpus gives no row.
    """
    # The histogram is small and read twice; written once, its texts are encoded once.
    rows = settle(histogram).withColumns({"block": F.expr(f"n_tokens div {BLOCK}"), "tokens": F.expr("n_docs * n_tokens")})
    # A block table has a row per 1,024 lengths; it alone is ordered as a whole.
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t")).selectExpr(
        "block", "sum(d) OVER () AS all_docs", "sum(t) OVER () AS all_tokens",
        "sum(d) OVER (ORDER BY block) - d AS d0", "sum(t) OVER (ORDER BY block) - t AS t0",
    )
    before = "OVER (PARTITION BY block ORDER BY n_tokens) - "
    sums = rows.join(blocks, "block").selectExpr(
        "n_tokens", "n_docs", "tokens", "all_docs", "all_tokens",
        f"d0 + sum(n_docs) {before} n_docs AS docs_below", f"t0 + sum(tokens) {before} tokens AS tokens_below",
    )
    return sums.selectExpr(
        "n_tokens", "n_docs", "tokens",
        "all_docs - docs_below AS docs_at_least", "all_tokens - tokens_below AS tokens_at_least",
        "tokens_below + n_tokens * (all_docs - docs_below) AS truncated_tokens",
        "all_tokens AS total_tokens",
        "docs_below / all_docs AS share_below", "(docs_below + n_docs) / all_docs AS share_to",
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``(context_limit, docs_over, truncated_tokens)`` for any limits, from the suffix sums.

    Between two lengths nothing ends, so the first length at or above a limit answers for it.
    """
    asked = sums.sparkSession.createDataFrame([(int(x),) for x in limits], "context_limit bigint")
    total = sums.agg(F.coalesce(F.max("total_tokens"), F.lit(0)))
    return asked.join(sums, F.expr("n_tokens > context_limit"), "left").groupBy("context_limit").agg(
        F.coalesce(F.max("docs_at_least"), F.lit(0)).alias("docs_over"),
        F.expr("coalesce(sum((n_tokens - context_limit) * n_docs), 0)").alias("cut"),
    ).select("context_limit", "docs_over", (total.scalar() - F.col("cut")).alias("truncated_tokens"))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``(share, n_tokens)``: the smallest length that at least that share of the documents doesn't exceed."""
    asked = sums.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    return asked.join(sums, F.expr("share_to >= share")).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
