"""Collocations: phrases that recur, from stripes of next-word counters.

A stripe belongs to a prefix of one or more words and counts what follows it: every frequent
next word under its own name, all else (rare words, ends of pieces) under null. Workers make
the stripes of a chunk of texts, the shuffle brings the stripes of a prefix together, and they
are added up element by element. One merged stripe then holds

* the extensions of its prefix (its entries are the candidates that are one word longer),
* the prefix total (the sum of its entries is how often the prefix occurs), and
* the subsumption maximum (its largest entry is the most frequent longer phrase).

Prefixes grow word by word. A phrase can be frequent only if both its prefix and its rest are,
which the workers ask of a bit filter of the frequent phrases. The filter has a fixed largest
size and no false negatives: where it is full it prunes less and nothing changes in the result.
The stripes of a prefix that holds more than 1/4096 of all words are cut into parts by the next
word, so no prefix meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from trialstats.llm.common import as_bytes, settle
from trialstats.llm.hashes import mix

# Words in the longest candidate, its least frequency, and the rows of a language in the result.
MAX_WORDS, MIN_COUNT, TOP = 3, 10, 2000
# A candidate goes if this share (percent) of it lies inside one longer candidate.
SUBSUMED = 50
# Bytes of text that a worker counts at a time.
CHUNK_BYTES = 12_000_000
# Bytes that are cut into words at a time.
SLICE_BYTES = 1 << 20
# The filter: bits a phrase, and the most bits altogether (16 MB).
FILTER_BITS, MOST_BITS = 16, 1 << 27
# A prefix with more than this part of all words has its stripes cut.
HEAVY = 4096
# Bits in a row of the bitmap aggregate.
_ROW_BITS = 32768

# The characters that end a piece, the one that ends a word besides the space, and what is lower-cased.
_ENDS, _TAB, _UPPER = b".,;:!?\n\x0b\x0c\r", b"\t", bytes(range(65, 91))
_TABLE = bytes.maketrans(_ENDS + _TAB + _UPPER, b"\n" * len(_ENDS) + b" " + _UPPER.lower())
# The score of a cut; the products may have 38 digits.
SCORE = (
    "(CAST(a AS decimal(16,0)) * CAST(a AS decimal(16,0)) * CAST(1000000 AS decimal(7,0)))"
    " div (CAST(l AS decimal(19,0)) * CAST(r AS decimal(19,0)))"
)
_NONE, _END = 0, 1  # ids of the empty word and of the end of a piece


class _Ids(dict):
    """Numbers of words in the order in which they appear."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _slices(data: bytes) -> Iterator[tuple[int, int]]:
    """Ranges of about ``SLICE_BYTES`` that end behind a space or an end; ``data`` ends with an end."""
    lo = 0
    while lo < len(data):
        hi = min(lo + SLICE_BYTES, len(data))
        if hi < len(data):
            cut = max(data.rfind(b" ", lo, hi), data.rfind(b"\n", lo, hi))
            hi = 1 + (cut if cut >= 0 else min(x for x in (data.find(b" ", hi), data.find(b"\n", hi)) if x >= 0))
        yield lo, hi
        lo = hi


def _split(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and ends in bytes, in order: a hash (0 for an end), and where each begins and ends."""
    end = data == 0x0A
    inside = ~(end | (data == 0x20))
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    at, first = np.flatnonzero(inside), np.flatnonzero(start)
    token = np.flatnonzero(start | end)
    is_word = start[token]
    value, stop = np.zeros(len(token), np.uint64), token + 1
    if len(first):
        starts = np.flatnonzero(start[at])
        place = (at - np.repeat(first, np.diff(starts, append=len(at)))).astype(np.uint64)
        sums = np.add.reduceat(mix((place << np.uint64(8)) + data[at] + np.uint64(1)), starts)
        value[is_word] = np.maximum(mix(sums), np.uint64(1))
        stop[is_word] = first + np.diff(starts, append=len(at))
    return value, token, stop


class _Chunk:
    """The words of some texts as numbers, with the language of each and the hash of each different word."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        names = _Ids()
        lang = np.fromiter(map(names.__getitem__, langs), np.int32, len(langs))
        translated = [t.translate(_TABLE) for t in texts]
        doc_ends = np.cumsum([len(t) + 1 for t in translated])
        data = b"\n".join([*translated, b""])
        del translated
        values, begins, ends = [np.zeros(1, np.uint64)], [], []  # an end in front
        for lo, hi in _slices(data):
            value, begin, end = _split(np.frombuffer(data, np.uint8, hi - lo, lo))
            values.append(value)
            begins.append((begin + lo).astype(np.uint32))
            ends.append((end + lo).astype(np.uint32))
        begin, end = np.concatenate(begins), np.concatenate(ends)
        # Numbers go by first appearance; the end in front gives ends theirs, right behind the empty word.
        number, different = pd.factorize(np.concatenate(values))
        del values, begins, ends
        number = number[1:].astype(np.int32)
        first = np.zeros(len(different), np.int64)
        first[number[::-1]] = np.arange(len(number) - 1, -1, -1)
        words = [b"", b"\n", *(data[a:b] for a, b in zip(begin[first[1:]].tolist(), end[first[1:]].tolist(), strict=True))]
        self.tokens = number + np.int32(_END)
        self.lang = np.repeat(lang, np.diff(np.searchsorted(begin, doc_ends), prepend=0))
        self.size = len(words)
        self.words = pa.array(words, pa.binary()).cast(pa.string())
        self.langs = pa.array(list(names), pa.string())
        self.hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
        self.lang_hashes = np.array([xxh3_64_intdigest(n.encode()) for n in names], np.uint64)

    def at(self, shift: int) -> np.ndarray:
        """The words that stand ``shift`` places further on; ends of pieces beyond the last."""
        return np.append(self.tokens[shift:], np.full(min(shift, len(self.tokens)), _END, np.int32))

    def phrases(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of every place the hash of the n words from there on, and whether they lie in one piece."""
        h, whole = self.lang_hashes[self.lang], np.ones(len(self.tokens), bool)
        for j in range(n):
            word = self.at(j)
            h = mix(h ^ self.hashes[word])
            whole &= word != _END
        return h, whole


def _phrase_hashes(langs: list[str], phrases: list[bytes]) -> np.ndarray:
    """Hashes as in ``_Chunk.phrases`` of phrases whose words are joined by spaces and equally many."""
    h = np.array([xxh3_64_intdigest(x.encode()) for x in langs], np.uint64)
    words = [p.split(b" ") for p in phrases]
    for j in range(len(words[0])):
        h = mix(h ^ np.array([xxh3_64_intdigest(w[j]) for w in words], np.uint64))
    return h


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[_Chunk]:
    texts, langs, size = [], [], 0
    for batch in batches:
        for text, lang in zip(as_bytes(batch.column("text")), batch.column("lang").to_pylist(), strict=True):
            texts.append(text)
            langs.append(lang)
            size += len(text)
            if size >= chunk_bytes:
                yield _Chunk(texts, langs)
                texts, langs, size = [], [], 0
    if texts:
        yield _Chunk(texts, langs)


def word_counts(texts: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(lang, word, n)`` of rows ``(text, lang)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, chunk_bytes):
            key, n = np.unique((chunk.lang.astype(np.int64) * chunk.size + chunk.tokens)[chunk.tokens != _END], return_counts=True)
            arrays = [chunk.langs.take(key // chunk.size), chunk.words.take(key % chunk.size), pa.array(n)]
            if len(key):
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "word", "n"])

    return texts.mapInArrow(run, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class _Known:
    """What a worker knows of the frequent phrases: the bit filter, and the parts of the heaviest ones."""

    def __init__(self, frequent: DataFrame, words: int):
        """``frequent``: rows ``(lang, phrase, n)``; ``words``: of all texts."""
        spark = frequent.sparkSession
        n = frequent.count()
        self.bits = min(MOST_BITS, max(_ROW_BITS, 1 << (FILTER_BITS * n).bit_length()))
        bits, limit = self.bits, max(1, words // HEAVY)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    h = _phrase_hashes(batch.column("lang").to_pylist(), as_bytes(batch.column("phrase")))
                    at = (h % np.uint64(bits)).astype(np.int64)
                    arrays = [pa.array(at // _ROW_BITS), pa.array(at % _ROW_BITS), pa.array(h.astype(np.int64)), batch.column("n")]
                    yield pa.RecordBatch.from_arrays(arrays, ["row", "bit", "h", "n"])

        placed = frequent.mapInArrow(place, "row bigint, bit bigint, h bigint, n bigint")
        data = np.zeros(bits // 8, np.uint8)
        # At most 4,096 rows of 4 KB, and 4,096 heavy phrases, as these make up all words at most once per place.
        for r in placed.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("map")).collect():
            data[r["row"] * _ROW_BITS // 8:(r["row"] + 1) * _ROW_BITS // 8] = np.frombuffer(r["map"], np.uint8)
        heavy = placed.where(f"n > {limit}").selectExpr("h", f"CAST(ceil(n / {limit}) AS bigint) AS parts").collect()
        heavy = sorted((np.uint64(r["h"] & (1 << 64) - 1), r["parts"]) for r in heavy)
        hashes = np.array([h for h, _ in heavy], np.uint64)
        parts = np.array([p for _, p in heavy], np.uint64)
        self.data = spark.sparkContext.broadcast((data, hashes, parts))

    def holds(self, h: np.ndarray) -> np.ndarray:
        at = h % np.uint64(self.bits)
        return (self.data.value[0][at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def parts(self, h: np.ndarray) -> np.ndarray:
        _, hashes, parts = self.data.value
        out = np.ones(len(h), np.uint64)
        if len(hashes):
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[at] == h
            out[hit] = parts[at[hit]]
        return out

    def __getstate__(self):
        return {"bits": self.bits, "data": self.data}


def _chunk_stripes(chunk: _Chunk, n: int, known: _Known) -> pa.RecordBatch | None:
    """The stripes of the frequent prefixes of ``n`` words in a chunk."""
    h, whole = chunk.phrases(n)
    frequent = whole & known.holds(h)
    start = np.flatnonzero(frequent)
    if not len(start):
        return None
    # Prefixes as numbers: made dense only where the next word would not fit beside them.
    code, most = chunk.lang[start].astype(np.int64), len(chunk.langs)
    for j in range(n + 1):
        if most * chunk.size >= 1 << 62:
            code, most = np.unique(code, return_inverse=True)[1], len(start)
        if j < n:
            code, most = code * chunk.size + chunk.at(j)[start], most * chunk.size
    follows = np.append(frequent[1:], False)[start]
    follow = np.where(follows, chunk.at(n)[start], _NONE)
    key, first, count = np.unique(code * chunk.size + follow, return_index=True, return_counts=True)
    code, follow, first = key // chunk.size, key % chunk.size, start[first]
    parts = known.parts(h[first])
    del h, whole, frequent, follows, start, key
    part = (chunk.hashes[follow] % parts).astype(np.int64)
    # Entries come by prefix; only those of cut prefixes have to be put in order by their part.
    cut = np.flatnonzero(parts > 1)
    order = np.arange(len(code))
    order[cut] = cut[np.lexsort((part[cut], code[cut]))]
    code, follow, first, part, count = code[order], follow[order], first[order], part[order], count[order]
    row = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (part[1:] != part[:-1])))
    offsets = pa.array(np.append(row, len(code)).astype(np.int32))
    prefix = [chunk.words.take(pa.array(chunk.at(j)[first[row]])) for j in range(n)]
    prefix = pc.binary_join_element_wise(*prefix, " ") if n > 1 else prefix[0]
    follow = chunk.words.take(pa.array(follow, mask=follow == _NONE))
    lists = [pa.ListArray.from_arrays(offsets, x) for x in (follow, pa.array(count))]
    arrays = [chunk.langs.take(pa.array(chunk.lang[first[row]])), prefix, pa.array(part[row]), *lists]
    return pa.RecordBatch.from_arrays(arrays, ["lang", "prefix", "part", "next", "n"])


def stripes(texts: DataFrame, n: int, known: _Known, min_count: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Merged stripes ``(lang, prefix, part, total, extensions)`` of the prefixes of ``n`` words.

    ``extensions`` lists the next words with at least ``min_count`` occurrences behind the prefix
    as ``(next, n)``; ``total`` counts everything in the part of the stripe.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, chunk_bytes):
            out = _chunk_stripes(chunk, n, known)
            if out is not None:
                yield out

    schema = "lang string, prefix string, part bigint, next array<string>, n array<bigint>"
    met = texts.mapInArrow(run, schema).repartition("lang", "prefix", "part")
    # The aggregates below follow the partitions of that shuffle.
    entries = met.select("lang", "prefix", "part", F.inline(F.arrays_zip("next", "n")))
    merged = entries.groupBy("lang", "prefix", "part", "next").agg(F.sum("n").alias("n"))
    extension = F.when(F.expr(f"next IS NOT NULL AND n >= {min_count}"), F.struct("next", "n"))
    return merged.groupBy("lang", "prefix", "part").agg(F.sum("n").alias("total"), F.collect_list(extension).alias("extensions"))


def candidates(
    df: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
    chunk_bytes: int = CHUNK_BYTES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: candidates ``(lang, phrase, prefix, rest, words, a)``, totals ``(lang, phrase, f)`` of
    everything shorter than the longest candidate that is frequent, and ``(lang, n)``, the number of words."""
    texts = df.select(
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
    )
    words = settle(word_counts(texts, chunk_bytes))
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = words.where(F.col("n") >= min_count).select("lang", F.col("word").alias("phrase"), "n")
    found, totals = None, None
    for n in range(1, max_words):
        merged = settle(stripes(texts, n, _Known(frequent, total), min_count, chunk_bytes))
        of_prefix = merged.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.sum("total").alias("f")).where(F.col("f") >= min_count)
        longer = merged.select("lang", "prefix", F.inline("extensions")).selectExpr(
            "lang", "concat(prefix, ' ', next) AS phrase", "prefix", "n AS a", f"{n + 1} AS words",
        ).withColumn("rest", F.expr("substring(phrase, instr(phrase, ' ') + 1)"))
        totals = of_prefix if totals is None else totals.unionByName(of_prefix)
        found = longer if found is None else found.unionByName(longer)
        frequent = longer.select("lang", "phrase", F.col("a").alias("n"))
    return found, totals, sizes


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang",
    max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, subsumed: int = SUBSUMED, top: int = TOP,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The best phrases of every language: ``(lang, rank, phrase, a, l, r, n, score)``.

    Texts in lower case (A-Z only) are cut into pieces at punctuation and line ends and those into
    words. A phrase of 2 to ``max_words`` words with ``a >= min_count`` occurrences is a candidate;
    of its cuts into a first part (``l`` occurrences) and a rest (``r``) the one with the lowest score
    ``floor(1000000 * a * a / (l * r))`` counts, the earlier one in a tie. It is left out if a longer
    candidate that holds it has at least ``subsumed`` percent of its occurrences. Ranks go by score,
    ``a`` and the phrase in byte order. All arithmetic is on whole numbers of up to 38 digits.

    A null text counts as empty, a null language as ``und``; repeated rows count as often as they are
    there; texts of any length are counted whole; other columns play no part; an empty table, or one
    without candidates, gives no rows.
    """
    found, totals, sizes = candidates(df, text, lang, max_words, min_count, chunk_bytes)
    found, totals = settle(found), settle(totals)
    cuts = found.select(
        "lang", "phrase", "a", F.explode(F.expr("sequence(1, words - 1)")).alias("k"), F.split("phrase", " ").alias("w")
    ).selectExpr(
        "lang", "phrase", "a", "k", "array_join(slice(w, 1, k), ' ') AS head", "array_join(slice(w, k + 1, size(w)), ' ') AS tail"
    )
    left = totals.selectExpr("lang", "phrase AS head", "f AS l")
    right = totals.selectExpr("lang", "phrase AS tail", "f AS r")
    worst = cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"]).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(F.expr(SCORE).alias("score"), "k", "l", "r")).alias("cut")
    )
    # The largest entry of a phrase's own stripe, and of the stripes that end in it.
    inside = found.selectExpr("lang", "prefix AS phrase", "a AS longer").unionByName(found.selectExpr("lang", "rest AS phrase", "a AS longer"))
    most = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = worst.join(most, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {subsumed} * a")
    rank = "row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase)"
    ranked = kept.withColumn("rank", F.expr(rank)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").selectExpr("lang", "rank", "phrase", "a", "cut.l AS l", "cut.r AS r", "n", "cut.score AS score")
