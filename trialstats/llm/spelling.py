"""Spelling variants: words one edit apart, found with FM-indexes in both directions.

If two words differ by one edit, they agree on the first half of either of them or on its last half.
Each word is therefore sent to the place of its first half and to the place of its last half,
and, as something to be found, to the places of the halves that words one longer or shorter
would ask for. A place holds an index over the delimited text of its words:

* where the last half is shared, the index of the text: a search starts at the delimiter behind the
  word, matches the last half exactly and extends across the first half to the left;
* where the first half is shared, the index of the text read backwards: a search starts before the
  word, matches the first half exactly and extends to the right.

While it extends, a search may take one error, and it ends at the delimiter on the other side. A search
state is an interval of suffix ranks; all searches of a place go on side by side. A pair that shares
both halves is reported by the first search only, so every pair comes once. Places are dealt
into buckets of bounded text; a half shared by more words than a bucket holds is dealt into
several pieces, each of which answers all of its searches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialstats.llm.common import settle

# The runs that are words, from which length and how often, and which runs lose a code point.
RUN, LEAST_LENGTH, LEAST_COUNT, DELETED = r"[A-Za-zÀ-ÿ]", 7, 2, 31
# A form is this many times as frequent as its variant.
FORM_FACTOR = 10
# Characters of the words in a bucket, about.
BUCKET_CHARS = 300_000


class FmIndex:
    """Suffix ranks of words, each with a delimiter behind it, for searches from the last character back.

    A step turns the interval of a string into that of the string with a character before it:
    the rows of the transform are sorted by (character, row), and a row's place there is its rank.
    """

    def __init__(self, words: list[np.ndarray]):
        """``words``: characters as numbers from 1."""
        n = len(words)
        lengths = np.array([len(w) for w in words]) + 1
        ends = np.cumsum(lengths) - 1
        text = np.zeros(lengths.sum(), np.int64)
        inner = np.ones(len(text), bool)
        inner[ends] = False
        text[inner] = np.concatenate(words)
        # Prefix doubling; the delimiters are ranked by their word, so all suffixes differ.
        rank = text + n - 1
        rank[ends] = np.arange(n)
        size, span = len(text), 1
        while True:
            after = np.append(rank[span:], np.zeros(min(span, size), np.int64))[:size]
            key = rank * (int(rank.max()) + 1 + size) + after
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            new = np.cumsum(np.append(False, sorted_key[1:] != sorted_key[:-1]))
            rank = np.empty(size, np.int64)
            rank[order] = new
            if new[-1] == size - 1:
                break
            span *= 2
        self.size, self.words = size, n
        self.before = text[order - 1]  # the first word has the last delimiter before it
        by_char = np.argsort(self.before, kind="stable")
        self.keys = self.before[by_char] * (size + 1) + by_char
        # Rows of whole words, and which word each is.
        self.whole = np.flatnonzero(self.before == 0)
        self.word_at = np.searchsorted(ends, order[self.whole])
        self.symbols = np.unique(text[inner])

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = symbol * (self.size + 1)
        return np.searchsorted(self.keys, base + lo), np.searchsorted(self.keys, base + hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What can stand before each interval: pairs of its number and a character."""
        width = hi - lo
        narrow = np.flatnonzero(width <= len(self.symbols))
        wide = np.flatnonzero(width > len(self.symbols))
        w = width[narrow]
        rows = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(lo[narrow], w)
        base = int(self.symbols[-1]) + 1
        key = np.unique(np.repeat(narrow, w) * base + self.before[rows])
        key = key[key % base > 0]
        state = np.concatenate([key // base, np.repeat(wide, len(self.symbols))])
        symbol = np.concatenate([key % base, np.tile(self.symbols, len(wide))])
        return state, symbol

    def one_edit(self, asked: list[np.ndarray], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the search, number of the word) that are exactly one edit apart.

        A search is a word spelt from its last character back, of which the first ``exact`` must agree.
        Of edits that come to the same (in a run of one character) the last is taken.
        """
        lengths = np.array([len(a) for a in asked])
        flat = np.append(np.concatenate(asked), 0)
        at = np.cumsum(lengths) - lengths
        lo, hi = np.zeros(len(asked), np.int64), np.full(len(asked), self.words)
        live = np.arange(len(asked))  # searches without an error so far
        none = np.zeros(0, np.int64)
        pool = (none, none, none)  # searches with their error behind them: number, interval
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for p in range(int(lengths.max()) + 1):
            live = live[lengths[live] >= p]
            branching = live[exact[live] <= p]
            ends = lengths[branching] == p
            want = np.where(ends, 0, flat[at[branching] + np.minimum(p, lengths[branching])])
            state, symbol = self.branches(lo[branching], hi[branching])
            state, symbol = state[symbol != want[state]], symbol[symbol != want[state]]
            q = branching[state]
            b_lo, b_hi = self.step(symbol, lo[q], hi[q])
            there = b_lo < b_hi
            q, state, b_lo, b_hi = q[there], state[there], b_lo[there], b_hi[there]
            # One more character in the word found: the search goes on where it is.
            pool = tuple(np.concatenate(x) for x in zip(pool, (q, b_lo, b_hi), strict=True))
            done = lengths[pool[0]] == p
            found.append(self._words(*(x[done] for x in pool)))
            pool = self._advance(flat[at[pool[0][~done]] + p], *(x[~done] for x in pool))
            # Another character, or one less: the search goes on behind it.
            other = ~ends[state]
            skip = branching[~ends]
            follow = flat[at[skip] + np.minimum(p + 1, lengths[skip])]
            skip = skip[(p + 1 == lengths[skip]) | (follow != flat[at[skip] + p])]
            new = (np.concatenate([q[other], skip]), np.concatenate([b_lo[other], lo[skip]]), np.concatenate([b_hi[other], hi[skip]]))
            pool = tuple(np.concatenate(x) for x in zip(pool, new, strict=True))
            live = live[lengths[live] > p]
            lo[live], hi[live] = self.step(flat[at[live] + p], lo[live], hi[live])
            live = live[lo[live] < hi[live]]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _advance(self, symbol, q, lo, hi):
        lo, hi = self.step(symbol, lo, hi)
        there = lo < hi
        return q[there], lo[there], hi[there]

    def _words(self, q, lo, hi):
        first, last = np.searchsorted(self.whole, lo), np.searchsorted(self.whole, hi)
        n = last - first
        rows = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        return np.repeat(q, n), self.word_at[rows]


def _bucket_pairs(words: list[str], n: np.ndarray, asks: np.ndarray, held: np.ndarray, backwards: bool) -> pa.Table:
    """Pairs ``(word, near, near_n)`` of a bucket of different words: those of ``asks`` search among those of ``held``.

    ``backwards``: the first half is exact and the index is over words read backwards.
    """
    points = np.concatenate([np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words])
    codes = np.unique(points, return_inverse=True)[1].astype(np.int64) + 1
    lengths = np.array([len(w) for w in words])
    spelt = np.split(codes, np.cumsum(lengths)[:-1])
    searching, there = np.flatnonzero(asks), np.flatnonzero(held)
    index = FmIndex([spelt[i][::-1] if backwards else spelt[i] for i in there])
    half = lengths[searching] // 2
    exact = half if backwards else lengths[searching] - half
    q, target = index.one_edit([spelt[i] if backwards else spelt[i][::-1] for i in searching], exact)
    q, target = searching[q], there[target]
    if not backwards:  # the other search finds what shares the first half
        other = np.array([not words[t].startswith(words[s][:len(words[s]) // 2]) for s, t in zip(q, target, strict=True)], bool)
        q, target = q[other], target[other]
    names = pa.array(words, pa.string())
    return pa.table({"word": names.take(pa.array(q)), "near": names.take(pa.array(target)), "near_n": pa.array(n[target])})


def near_pairs(words: DataFrame, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """``(word, near, near_n)`` for all words one inserted, deleted or replaced code point apart, in both directions.

    ``words``: rows ``(word, n)`` of different words of at least two code points. A null word has no row
    in the result, and an empty table gives none; words of any length are searched whole.
    """
    words = words.where("char_length(word) > 1")
    half = "int(char_length(word) / 2)"
    up, down = "int((char_length(word) + 1) / 2)", "int((char_length(word) - 1) / 2)"
    # Halves that a word asks for (asks) and is to be found at: in front, and at the back.
    other = f"IF({half} = {up}, {down}, {up})"
    sides = (
        f"array(struct(true AS front, left(word, {half}) AS half, true AS asks),"
        f" struct(true AS front, left(word, {other}) AS half, false AS asks),"
        f" struct(false AS front, right(word, char_length(word) - {half}) AS half, true AS asks),"
        f" struct(false AS front, right(word, IF({half} = {up}, {up} + 1, {half})) AS half, false AS asks))"
    )
    placed = words.select("word", "n", F.inline(F.expr(sides)))
    held = placed.groupBy("front", "half").agg(F.sum(F.expr("char_length(word) + 1")).alias("chars"))
    total = words.agg(F.coalesce(F.sum(F.expr("char_length(word) + 1")), F.lit(0))).first()[0]
    buckets = max(1, 4 * total // bucket_chars)
    giant = held.where(F.col("chars") > bucket_chars).selectExpr("front", "half", f"CAST(ceil(chars / {bucket_chars}) AS bigint) AS pieces")
    # Words that share a giant half are dealt into pieces, and each piece searches in every piece.
    grid = (
        "IF(m = 1, array(struct(0L AS i, 0L AS j, asks AS ask, true AS held)), concat("
        "IF(asks, transform(sequence(0L, m - 1), j -> struct(own AS i, j, true AS ask, false AS held)), array()),"
        "transform(sequence(0L, m - 1), i -> struct(i, own AS j, false AS ask, true AS held))))"
    )
    spread = placed.join(settle(giant), ["front", "half"], "left").selectExpr(
        "*", "coalesce(pieces, 1L) AS m", "pmod(xxhash64(word), coalesce(pieces, 1L)) AS own"
    ).select("front", "half", "m", "word", "n", F.inline(F.expr(grid))).selectExpr(
        # Giant halves stand alone, as a word that searches in several buckets must find a word in one of them.
        "front", f"IF(m = 1, pmod(xxhash64(half), {buckets}), NULL) AS bucket", "IF(m = 1, NULL, half) AS giant", "i", "j",
        "word", "n", "ask", "held",
    )

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        # A word may be here for two of its halves.
        merged = table.group_by("word").aggregate([("n", "max"), ("ask", "max"), ("held", "max")])
        ask, held = (merged[c].to_numpy(zero_copy_only=False) for c in ("ask_max", "held_max"))
        if not ask.any() or not held.any():
            return table.slice(0, 0).select(["word", "word", "n"]).rename_columns(["word", "near", "near_n"])
        return _bucket_pairs(merged["word"].to_pylist(), merged["n_max"].to_numpy(), ask, held, key[0].as_py())

    return spread.groupBy("front", "bucket", "giant", "i", "j").applyInArrow(run, "word string, near string, near_n bigint")


def vocabulary(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)``: the words of whole texts with their occurrences.

    Runs of letters are lower-cased (A-Z only). Where 31 divides the crc32 of ``<doc_id>:<run>``, the run
    loses the code point at the remainder of that crc32 by its length; a null id stands as empty there.
    Only words of at least ``LEAST_LENGTH`` code points with ``LEAST_COUNT`` occurrences stay.
    """
    upper = "".join(map(chr, range(65, 91)))
    # Shorter runs can't give a word.
    runs = df.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(f"{RUN}{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"),
    )
    # The plain function is quicker and does the same to ASCII.
    lower = f"IF(octet_length(run) = char_length(run), lower(run), translate(run, '{upper}', '{upper.lower()}'))"
    hashed = runs.selectExpr("id", f"{lower} AS run").selectExpr("run", "crc32(concat(id, ':', run)) AS h")
    place = "CAST(h % char_length(run) AS int)"
    word = f"IF(h % {DELETED} = 0, concat(left(run, {place}), substring(run, {place} + 2)), run)"
    counted = hashed.selectExpr(f"{word} AS word").groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(f"n >= {LEAST_COUNT} AND char_length(word) >= {LEAST_LENGTH}")


def variants(words: DataFrame, factor: int = FORM_FACTOR, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for words ``(word, n)``.

    The form is the near word of largest ``n`` (the first in code point order in a tie) if that is at least
    ``factor`` times the word's own, else null; the root follows forms to the last. Counts grow by that
    factor at each step, so a few rounds of doubling reach every root.
    """
    words = settle(words)
    best = near_pairs(words, bucket_chars).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(F.expr("-near_n AS less"), "near")).alias("best")
    )
    joined = settle(words.join(best, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0) AS n_near",
        f"IF(-best.less >= {factor} * n, best.near, NULL) AS form", f"IF(-best.less >= {factor} * n, -best.less, NULL) AS form_n",
    ))
    # Only words with a form move; byte order of UTF-8 is code point order.
    jumps = joined.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    moved = jumps.join(jumps.selectExpr("word AS root"), "root", "left_semi").limit(1).count()
    while moved:
        far = jumps.selectExpr("word AS root", "root AS further")
        jumps = settle(jumps.join(far, "root", "left").selectExpr("word", "coalesce(further, root) AS root", "further IS NOT NULL AS moved"))
        moved = jumps.where("moved").limit(1).count()
        jumps = jumps.drop("moved")
    return joined.join(jumps, "word", "left").selectExpr("word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n")


def document_variants(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", factor: int = FORM_FACTOR, bucket_chars: int = BUCKET_CHARS,
) -> DataFrame:
    """Variants of the words of whole texts: ``(word, form, root, n, n_near, form_n)``, a row per word.

    Null and empty texts hold no words, repeated rows count as often as they are there, runs of any length are
    words, other columns play no part, and an empty table gives no rows. See ``vocabulary`` and ``variants``.
    """
    return variants(vocabulary(df, doc_id, text), factor, bucket_chars)
