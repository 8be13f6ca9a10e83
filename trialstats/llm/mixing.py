"""Mixing sources to target weights by pivotal dependent rounding.

The share of a source decides how often each of its documents is wanted: a whole number of
copies and a fraction. Fractions are settled in pairs: some probability mass, measured in
words, moves from one document to the other, in a direction drawn so that no expectation
changes, until one of the two is certain. The words of a source thus stay what they should
be. Sources are dealt into parts of bounded size; each part leaves one open document
at most, and a tree of further rounds pairs those, part by part, until one is left per
source. In a pair the smaller document ends first, so the one that is left is large. A
reserve of documents, chosen by a hash, is therefore kept out of the rounds: from the large
to the small, each document left is drawn and what it takes too much or too little
is passed on to all smaller ones in the reserve. The words taken differ from the target by about
the smallest document of the reserve.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialstats.llm.common import WORD, settle

# The weights that sources take in turn, and the most copies of a document.
WEIGHTS, MAX_COPIES = (5, 2, 1), 3
# Documents in a part, and parts whose open documents meet in the next round.
PART_DOCS, FAN = 4000, 1024
# Documents of a source in its reserve, about.
RESERVE = 512


def word_count(text: str) -> str:
    """Number of words of a text as an expression; null has none."""
    return f"CAST(coalesce(regexp_count({text}, r'{WORD}'), 0) AS bigint)"


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MAX_COPIES) -> DataFrame:
    """``(source, source_size, source_docs, target)`` from rows ``(source, size)``.

    Sources in code point order, null last, take the weights in turn and share the total size.
    A target ends at ``most`` times its source; what is beyond goes to the others by weight.
    That is the level at which all are filled in order of cap over weight, so running sums
    over one row per source solve it. Sources without words have target 0.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs"))
    weight = "element_at(array({}), CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % {} AS int) + 1)".format(
        ", ".join(f"{w}D" for w in weights), len(weights)
    )
    ranked = sizes.selectExpr("*", f"{weight} AS w", f"{most}D * source_size AS cap").selectExpr("*", "cap / w AS fill")
    order = "ORDER BY fill, source IS NULL, source"
    levels = ranked.selectExpr(
        "*",
        f"(sum(source_size) OVER () - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))"
        f" / sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level",
    )
    return levels.selectExpr(
        "source", "source_size", "source_docs",
        "IF(level >= fill, cap, w * min_by(level, IF(level < fill, fill, NULL)) OVER ()) AS target",
    )


def pivotal(sizes: np.ndarray, shares: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Round ``shares`` (0 to 1) to 0 or 1 by passing words between pairs; at most one stays open.

    Returns the shares and the index of the open one, or -1. Documents without words are drawn
    on their own, as nothing can be passed to them.
    """
    shares = shares.copy()
    draws = rng.random(len(shares)).tolist()
    p, words = shares.tolist(), sizes.tolist()
    held = -1
    for j in range(len(p)):
        if p[j] <= 0 or p[j] >= 1:
            continue
        if not words[j]:
            p[j] = float(draws[j] < p[j])
            continue
        if held < 0:
            held = j
            continue
        i = held
        up = min((1 - p[i]) * words[i], p[j] * words[j])
        down = min(p[i] * words[i], (1 - p[j]) * words[j])
        if draws[j] * (up + down) < down:
            i_ends, j_ends = (1 - p[i]) * words[i] <= up, p[j] * words[j] <= up
            p[i], p[j] = 1.0 if i_ends else p[i] + up / words[i], 0.0 if j_ends else p[j] - up / words[j]
        else:
            i_ends, j_ends = p[i] * words[i] <= down, (1 - p[j]) * words[j] <= down
            p[i], p[j] = 0.0 if i_ends else p[i] - down / words[i], 1.0 if j_ends else p[j] + down / words[j]
        held = -1 if i_ends and j_ends else j if i_ends else i
        if held >= 0 and not 0 < p[held] < 1:  # rounding of the last digit
            p[held] = float(round(p[held]))
            held = -1
    return np.array(p, float), held


def settle_reserve(sizes: np.ndarray, wanted: np.ndarray, most: float, rng: np.random.Generator) -> np.ndarray:
    """Whole copies (0 to ``most``) of documents sorted from large to small, whose words add up to those wanted.

    Each document is drawn between the whole numbers around its ``wanted``; the difference in words goes
    to the smaller ones, in proportion to how far each is from 0 and ``most``, so that a draw moves
    them up or down alike and no expectation changes. Only where they have too little room for
    that does it go to those that have some, and if there is none for either, the nearer number is taken.
    """
    w = wanted.astype(float)
    for k, n in enumerate(sizes.tolist()):
        low = float(np.floor(w[k] + 1e-9))
        share = w[k] - low
        if share < 1e-9:
            w[k] = low
            continue
        rest, words = w[k + 1:], sizes[k + 1:]
        room = np.minimum(rest, most - rest)
        mass = float(room @ words)
        taken = low + float(rng.random() < share)
        if n and n * max(share, 1 - share) > mass:
            room_of = {low: float((most - rest) @ words), low + 1: float(rest @ words)}
            missed = {c: max(0.0, abs(w[k] - c) * n - r) for c, r in room_of.items()}
            if missed[taken] > min(missed.values()):
                taken = min(missed, key=missed.get)
            room = most - rest if taken == low else rest
            mass = float(room @ words)
        if n and mass > 0:
            moved = (w[k] - taken) * n
            w[k + 1:] = np.clip(rest + room * max(-1.0, min(1.0, moved / mass)), 0, most)
        w[k] = taken
    return w


def _round(rows: DataFrame, level: int, seed: int, most: int | None) -> DataFrame:
    """One round: settle the shares inside each ``(source, part)``; with ``most``, the last one, settle all that is left."""

    def run(table: pa.Table) -> pa.Table:
        order = [("size", "descending"), ("tie", "ascending"), ("share", "ascending"), ("whole", "ascending")]
        table = table.sort_by(order)
        source, part = table["source"][0].as_py(), table["part"][0].as_py()
        stamp = 0 if source is None else zlib.crc32(source.encode("utf-8")) + 1
        rng = np.random.default_rng([seed, stamp, part, level])
        sizes, shares, whole = (table[c].to_numpy() for c in ("size", "share", "whole"))
        kept = table["reserve"].to_numpy()
        outside = np.flatnonzero(~kept)
        shares = shares.copy()
        shares[outside], held = pivotal(sizes[outside], shares[outside], rng)
        if most is not None:
            left = np.flatnonzero(kept | ((shares > 0) & (shares < 1)))
            copies = settle_reserve(sizes[left], whole[left] + shares[left], most, rng)
            whole = whole.copy()
            whole[left], shares[left] = copies.astype(np.int32), 0.0
        table = table.set_column(table.column_names.index("share"), "share", pa.array(shares))
        return table.set_column(table.column_names.index("whole"), "whole", pa.array(whole, pa.int32()))

    return rows.groupBy("source", "part").applyInArrow(run, rows.schema)


def mix(
    df: DataFrame,
    text: str = "text",
    source: str = "source",
    size: str | None = None,
    weights: Sequence[float] = WEIGHTS,
    most: int = MAX_COPIES,
    seed: int = 9,
    part_docs: int = PART_DOCS,
    fan: int = FAN,
    reserve: int = RESERVE,
) -> DataFrame:
    """Rows ``(row, size, source_size, target, copies)`` for every row of ``df``.

    ``size`` is an expression for the size of a document; without it the words of its text count.
    ``copies`` is how often the mix takes the document, 0 to ``most``. The result depends on
    the rows and the seed, not on their partitions. Equal rows are told apart by nothing, so
    which of them is taken once more doesn't matter; null ids, texts and sources are values
    like any other.
    """
    hashed = ", ".join(f"`{c}`" for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind)
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.expr(size or word_count(f"`{text}`")).cast("bigint").alias("size"),
        F.expr(f"xxhash64({hashed})").alias("tie"),
    )
    targets = settle(source_targets(rows.select("source", "size"), weights, most))
    parts = targets.selectExpr("source AS s", "source_size", "source_docs", "target", f"CAST(ceil(source_docs / {part_docs}) AS bigint) AS parts")
    shared = rows.join(parts, F.expr("source <=> s")).selectExpr(
        "row", "source", "size", "source_size", "target", "tie",
        f"least({most}D, coalesce(target / nullif(source_size, 0), 0)) AS wanted", "parts",
        f"pmod(xxhash64(tie), source_docs) < {reserve} AS reserve",
    ).selectExpr(
        "row", "source", "size", "source_size", "target", "tie", "IF(reserve, 0L, CAST(pmod(tie, parts) AS bigint)) AS part", "reserve",
        "CAST(floor(wanted) AS int) AS whole", "wanted - floor(wanted) AS share",
    )
    left = parts.agg(F.max("parts")).first()[0] or 1
    held = shared.where("reserve")  # about ``reserve`` rows of each source
    level, done = 0, []
    open_rows = shared.where("NOT reserve")
    while left > 1:
        settled = settle(_round(open_rows, level, seed, None))
        done.append(settled.where("share <= 0 OR share >= 1"))
        open_rows = settled.where("share > 0 AND share < 1").withColumn("part", F.expr(f"part div {fan}"))
        left, level = -(-left // fan), level + 1
    done.append(settle(_round(open_rows.unionByName(held), level, seed, most)))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.selectExpr("row", "size", "source_size", "target", "whole + CAST(share AS int) AS copies")


def mixed_rows(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them, in the columns of ``df``."""
    taken = mix(df, **options).where("copies > 0")
    return taken.select("row", F.explode(F.expr("sequence(1, copies)")).alias("copy")).select("row.*")


def taken_words(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per document its size, the size and target of its source, and the words that the mix takes."""
    # The mix needs words only, so rows carry their number and a mark of the text instead of it.
    light = settle(df.selectExpr(
        f"`{doc_id}` AS doc_id", f"`{source}` AS source", f"{word_count(f'`{text}`')} AS size", f"xxhash64(`{text}`) AS mark"
    ))
    return mix(light, size="size").selectExpr("row.doc_id AS doc_id", "size", "source_size", "target", "copies * size AS taken")
