"""Quality rules with thresholds that follow each language and source.

Every text is measured once. Quantile sketches of the measures are built per language and
source, merged into sketches per language and overall for groups too small to stand alone,
and turned into fences: a document fails a rule if its measure lies far outside the middle
half of its own group. The fences are joined back to the measured documents. Sketches are
mergeable and of fixed size, so a source that holds a third of all rows is combined before
the shuffle like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialstats.llm.common import as_bytes, by_batch, settle

# What the contract calls symbols, and the cutoffs of the base rule.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
# Documents that a group needs for fences of its own.
GROUP_DOCS = 100
# Fences stand this many widths of the middle half beyond it.
REACH = 4.0
# Rules: the measure, and the least distance of its fences from the middle half. Lower fences
# exist where a small value is bad, too. The mean of fewer than 20 word lengths says too little.
# Repeated words have a fence below the cutoff of the base rule, so that it can act.
RULES = {
    "word_length": ("IF(n_words >= 20, word_chars / n_words, NULL)", 1.5, True),
    "symbol_share": ("n_symbols / n_words", 0.1, False),
    "dup_line_share": ("n_dup_lines / n_lines", 0.4, False),
    "repeat_share": ("n_repeat_words / n_words", 0.15, False),
    "upper_share": ("n_upper / word_chars", 0.25, False),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]

_SPACES = [0x20, *range(0x09, 0x0E)]
_SYMBOLS = list(SYMBOLS)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of five that occur twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2 or len(set(words)) == len(words):
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h = (h ^ (h >> np.uint64(29))) * _FACTOR + ids[k:k + n]
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(h, twice)
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW):
        covered[k:k + n] |= hit
    return int(covered.sum())


def measure(text: bytes) -> list[int]:
    """The ``MEASURES`` of a text."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    return [
        len(words),
        int(counts.sum() - counts[0x80:0xC0].sum() - counts[_SPACES].sum()),
        int(counts[_SYMBOLS].sum()),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        int(counts[0x41:0x5B].sum()),
    ]


def measured(df: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Rows ``(row, MEASURES)``: the columns ``keep`` of ``df`` (all) as a struct and the measures of its text."""
    row = F.struct(*[F.col(f"`{c}`") for c in (keep or df.columns)]).alias("row")
    packed = df.select(row, F.col(f"`{text}`").cast("string").alias("text"))
    kind = packed.schema["row"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([measure(t or b"") for t in as_bytes(batch.column("text"))], np.int64)
        return pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, values.T)], ["row", *MEASURES])

    return packed.mapInArrow(by_batch(run), f"row {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES))


def base_failed() -> str:
    """The base rule as an expression."""
    return f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"


def fences(measures: DataFrame, group_docs: int = GROUP_DOCS, reach: float = REACH) -> DataFrame:
    """One row per ``(lang, source)`` with ``low_<rule>`` and ``high_<rule>``.

    A group of fewer than ``group_docs`` documents takes the fences of its language, and a
    small language those of all documents. Texts without words have no measures; a rule without
    any measure has no fences and rejects nothing.
    """
    sketched = [F.expr(f"kll_sketch_agg_double(CAST({e} AS double)) AS {r}") for r, (e, _, _) in RULES.items()]
    merged = [F.expr(f"kll_merge_agg_double({r}) AS {r}") for r in RULES]
    # Written once, as the sketches are merged and read: the texts are measured once for them.
    groups = settle(measures.where("n_words > 0").groupBy("lang", "source").agg(F.count("*").alias("n"), *sketched))
    langs = groups.groupBy("lang").agg(F.sum("n").alias("n"), *merged)
    everything = langs.groupBy().agg(*merged)

    def bounds(df: DataFrame, kept: list[str]) -> DataFrame:
        out = [*kept]
        for r, (_, least, both) in RULES.items():
            q = f"IF(kll_sketch_get_n_double({r}) > 0, kll_sketch_get_quantile_double({r}, {{}}), NULL)"
            width = f"greatest({reach} * ({q.format('0.75D')} - {q.format('0.25D')}), {least}D)"
            out.append(f"{q.format('0.75D')} + {width} AS high_{r}")
            out.append(f"{f'{q.format("0.25D")} - {width}' if both else 'double(NULL)'} AS low_{r}")
        return df.selectExpr(*out)

    names = [f"{side}_{r}" for r in RULES for side in ("high", "low")]
    # Group rows only: a row per language and source, one per language, one overall.
    wide = (
        bounds(groups, ["lang", "source", "n"]).alias("g")
        .join(bounds(langs, ["lang", "n"]).alias("l"), F.expr("g.lang <=> l.lang"))
        .join(bounds(everything, ["1 AS one"]).alias("a"), F.expr("a.one = if(g.n >= 0, 1, 0)"))
    )
    chosen = [f"CASE WHEN g.n >= {group_docs} THEN g.{c} WHEN l.n >= {group_docs} THEN l.{c} ELSE a.{c} END AS {c}" for c in names]
    return wide.selectExpr("g.lang AS lang", "g.source AS source", *chosen)


def judge(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", group_docs: int = GROUP_DOCS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Rows ``(row, MEASURES, base_failed, failed, kept)`` for every row of ``df``.

    ``failed`` lists the rules that a document fails. It is kept if it passes the base rule
    and fails none. A null text has no words and is not kept; null languages and sources are
    groups like any other. ``keep`` names the columns of ``df`` that ``row`` holds, language and
    source among them. The fences are written first, so that their size decides how they are joined.
    """
    def grouped(kept: Sequence[str] | None) -> DataFrame:
        return measured(df, text, kept).selectExpr("*", f"row.`{lang}` AS lang", f"row.`{source}` AS source")

    limits = settle(fences(grouped([lang, source]), group_docs))
    rows = grouped(keep)
    tests = []
    for r, (e, _, both) in RULES.items():
        beyond = f"{e} > high_{r}" + (f" OR {e} < low_{r}" if both else "")
        tests.append(f"IF(n_words > 0 AND ({beyond}), '{r}', NULL)")
    joined = rows.alias("d").join(limits.alias("f"), F.expr("d.lang <=> f.lang AND d.source <=> f.source"), "left")
    return joined.selectExpr(
        "row", *MEASURES, f"{base_failed()} AS base_failed", f"array_compact(array({', '.join(tests)})) AS failed"
    ).selectExpr("*", "NOT base_failed AND size(failed) = 0 AS kept")


def verdicts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Per document the base measures, the base verdict and the verdict of all rules."""
    rows = df.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"),
        F.col(lang).alias("lang"), F.col(source).alias("source"),
    )
    light = judge(rows, keep=["doc_id", "lang", "source"])
    return light.selectExpr(
        "row.doc_id AS doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "array_join(failed, ',') AS failed",
    )
