"""Language identification with interpolated Kneser-Ney models of characters.

The models are fitted on a bounded sample of labelled rows: about ``SAMPLE_ROWS`` per language,
chosen by a hash of the row, and less where many languages share the budget of rows and
characters; every language keeps a row. Character n-grams are counted in Spark; the sorted hash
arrays of a few languages share one set of keys per order, so that one lookup serves them all.
The sample bounds their size, and so what is broadcast. A text is given the language of the
lowest cross-entropy per character. A part of the sample is kept from the counts: it sets how
far apart two entropies must be for certainty, and the entropy above which a language is
rejected.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialstats.llm.common import by_batch
from trialstats.llm.hashes import SortedHashes, discounts, mix

# Characters in an n-gram, labelled rows per language (about), and one row in so many that calibrates.
ORDER, SAMPLE_ROWS, HOLD = 5, 1500, 5
# The budget that all languages share: rows, as a multiple of those of a language, and characters.
SAMPLE_SHARES, SAMPLE_CHARACTERS = 100, 16_000_000
# Languages whose models share their keys; a key takes room for each of them.
GROUP = 8
# Fixed value: the answer for a text without letters.
UNDETERMINED = "und"
# Share of calibration rows that may lie above the entropy of rejection.
REJECT_SHARE = 0.005
# Positions that are looked up together.
SLICE = 1 << 18

_SPACE = np.uint32(32)
_STEP, _FACTOR = 0xD6E8FEB86659FD93, 0x100000001B3


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def characters(text: str) -> tuple[np.ndarray, bool]:
    """Lower-case letters with one space for everything between words, and whether there are letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    points = np.where(letter, points, _SPACE)
    kept = letter | np.append(True, letter[:-1])[:len(points)]
    return points[kept], bool(letter.any())


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of several texts, each after a run of spaces, and where each text begins."""
    pad = np.full(ORDER - 1, _SPACE)
    parts = [x for t in texts for x in (pad, t)]
    begins = np.cumsum([0, *(len(t) + ORDER - 1 for t in texts)])[:-1] + ORDER - 1
    return np.concatenate(parts) if parts else pad[:0], begins


def gram_keys(points: np.ndarray) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each place, for n = 0 to ORDER."""
    chars = points.astype(np.uint64) + np.uint64(1)
    plain = chars.copy()
    keys = [np.zeros(len(chars), np.uint64), mix(plain + np.uint64(_STEP))]
    for n in range(2, ORDER + 1):
        plain[n - 1:] += chars[:len(chars) - n + 1] * np.uint64(_FACTOR ** (n - 1) % 2**64)
        keys.append(mix(plain + np.uint64(n * _STEP % 2**64)))
    return keys


def _level(sizes: list[int], budget: float) -> float:
    """The most that each may take so that the sum of what they take stays within the budget."""
    for i, size in enumerate(sorted(sizes)):
        if size * (len(sizes) - i) > budget:
            return budget / (len(sizes) - i)
        budget -= size
    return float("inf")


def _sample(df: DataFrame, rows: int, characters: int = SAMPLE_CHARACTERS) -> DataFrame:
    """About ``rows`` rows of each language, by a hash of text and language; all where there are fewer.

    Where languages are many or texts are long, they share ``SAMPLE_SHARES`` times ``rows`` rows and
    ``characters`` characters, and small languages leave their part to the others. Each keeps at
    least the row of the least hash, which is counted; a text is cut at the part of its language.
    """
    draw = F.pmod(F.xxhash64("text", "lang", F.lit(1)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = df.select("lang", "text", draw.alias("draw"))
    counts = drawn.groupBy("lang").agg(
        F.count("*").alias("n"), F.sum(F.char_length("text")).alias("size"), F.min("draw").alias("least")
    ).collect()  # one row per language
    if not counts:
        return df.limit(0).selectExpr("lang", "text", "false AS held")
    most = min(rows, _level([r["n"] for r in counts], SAMPLE_SHARES * rows))
    room = _level([r["size"] for r in counts], characters)
    limit = int(min(max(1, room), 2**31 - 1))
    shares = [(r["lang"], r["least"], max(r["least"], min(1.0, most / r["n"], room / max(1, r["size"])))) for r in counts]
    wanted = df.sparkSession.createDataFrame(shares, "lang string, least double, share double")
    held = (F.pmod(F.xxhash64("text", "lang", F.lit(2)), F.lit(HOLD)) == 0) & (F.col("draw") > F.col("least"))
    chosen = drawn.join(F.broadcast(wanted), "lang").where("draw <= share").withColumn("held", held)
    return chosen.select("lang", F.expr(f"left(text, {limit})").alias("text"), "held")


def _counts(sample: DataFrame) -> DataFrame:
    """``(lang, n, key, context, suffix, count)``: distinct n-grams of each order of the sample."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = [characters(t)[0] for t in batch.column("text").to_pylist()]
        out = []
        for lang in sorted(set(langs)):
            points, begins = _joined([t for t, x in zip(texts, langs, strict=True) if x == lang])
            keys = gram_keys(points)
            real = np.ones(len(points), bool)
            for k in range(1, ORDER):
                real[begins - k] = False
            at = np.flatnonzero(real)
            for n in range(1, ORDER + 1):
                key, first, count = np.unique(keys[n][at], return_index=True, return_counts=True)
                place = at[first]
                out.append(pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(key), pa.string()), pa.array(np.full(len(key), n, np.int32)),
                    *(pa.array(x.view(np.int64)) for x in (key, keys[n - 1][place - 1], keys[n - 1][place])),
                    pa.array(count.astype(np.int64)),
                ], ["lang", "n", "key", "context", "suffix", "count"]))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if out else None

    schema = "lang string, n int, key bigint, context bigint, suffix bigint, count bigint"
    return sample.select("lang", "text").mapInArrow(by_batch(run), schema).groupBy("lang", "n", "key", "context", "suffix").agg(
        F.sum("count").alias("count")
    )


class Models:
    """The models of all languages, in groups of ``GROUP`` that share their keys."""

    def __init__(self, counts: pa.Table):
        self.langs = sorted(pc.unique(counts["lang"]).to_pylist())
        symbols = len(pc.unique(counts.filter(pc.equal(counts["n"], 1))["key"])) + 1
        groups = [self.langs[i:i + GROUP] for i in range(0, len(self.langs), GROUP)]
        self.groups = [GroupModels(counts.filter(pc.is_in(counts["lang"], pa.array(g))), symbols) for g in groups]

    def entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """Cross-entropy per character of every text under every language."""
        return np.hstack([g.entropies(texts) for g in self.groups])

    def _log_p(self, keys: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        return np.hstack([g._log_p(keys, at) for g in self.groups])


class GroupModels:
    """Interpolated models of some languages: per order the sorted hashes, the logarithms of the
    probabilities and, for the n-gram as a context, of the mass left to the lower order."""

    def __init__(self, counts: pa.Table, symbols: int):
        self.langs = sorted(set(counts["lang"].to_pylist()))
        number = {x: i for i, x in enumerate(self.langs)}
        lang = np.array([number[x] for x in counts["lang"].to_pylist()], np.int64)
        n, count = counts["n"].to_numpy(), counts["count"].to_numpy()
        key, context, suffix = (np.ascontiguousarray(counts[c].to_numpy()).view(np.uint64) for c in ("key", "context", "suffix"))
        size = len(self.langs)
        self.index: list[SortedHashes] = [SortedHashes(np.zeros(1, np.uint64))]
        # What stands before the first character is a context, too, though nothing predicts it.
        start = gram_keys(_joined([np.zeros(0, np.uint32)])[0])
        self.index += [SortedHashes(np.unique(np.append(key[n == k], start[k][-1:] if k < ORDER else key[:0]))) for k in range(1, ORDER + 1)]
        lower = np.full((1, size), 1.0 / symbols)
        self.log_p, self.log_left = [np.log(lower).astype(np.float32)], []
        for k in range(1, ORDER + 1):
            rows = n == k
            at, own = self.index[k].find(key[rows]), lang[rows]
            adjusted = np.zeros((len(self.index[k].keys), size))
            if k == ORDER:
                adjusted[at, own] = count[rows]
            else:  # how many different characters come before
                longer = n == k + 1
                np.add.at(adjusted, (self.index[k].find(suffix[longer]), lang[longer]), 1)
            before = np.zeros(len(adjusted), np.int64)
            before[at] = self.index[k - 1].find(context[rows])
            if (before[at] < 0).any():
                raise AssertionError("a context of the training texts is missing")
            after = np.zeros(len(adjusted), np.int64)
            after[at] = self.index[k - 1].find(suffix[rows])
            if 1 < k < ORDER:  # the start backs off to a shorter one
                place = self.index[k].find(start[k][-1:])
                before[place] = after[place] = self.index[k - 1].find(start[k - 1][-1:])
            total = np.zeros((len(self.index[k - 1].keys), size))
            left = np.zeros_like(total)
            off = np.zeros_like(adjusted)
            for i in range(size):
                a = adjusted[:, i]
                d = discounts(np.array([(a == c).sum() for c in (1, 2, 3, 4)]))[np.minimum(a, 3).astype(np.int64)]
                off[:, i] = a - d
                np.add.at(total[:, i], before, a)
                np.add.at(left[:, i], before, d)
            seen = total > 0
            left = np.where(seen, left / np.where(seen, total, 1), 1.0)
            share = np.where(seen[before], off / np.where(seen, total, 1)[before], 0.0)
            lower = share + left[before] * lower[after]
            self.log_left.append(np.log(left).astype(np.float32))
            self.log_p.append(np.log(lower).astype(np.float32))

    def entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """Cross-entropy per character of every text under every language."""
        points, begins = _joined(texts)
        out = np.zeros((len(texts), len(self.langs)))
        lengths = np.array([len(t) for t in texts])
        keys = gram_keys(points)
        places = np.concatenate([np.arange(b, b + n) for b, n in zip(begins, lengths, strict=True)]) if len(texts) else begins
        owner = np.repeat(np.arange(len(texts)), lengths)
        for lo in range(0, len(places), SLICE):
            at = places[lo:lo + SLICE]
            got = self._log_p(keys, at)
            whose = owner[lo:lo + SLICE]
            first = np.flatnonzero(np.append(True, whose[1:] != whose[:-1]))
            out[whose[first]] -= np.add.reduceat(got, first, axis=0, dtype=np.float64)
        return out / np.maximum(lengths, 1)[:, None]

    def _log_p(self, keys: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), len(self.langs)), np.float32)
        todo = np.arange(len(at))
        for k in range(ORDER, 0, -1):
            found = self.index[k].find(keys[k][at[todo]])
            hit = found >= 0
            out[todo[hit]] += self.log_p[k][found[hit]]
            todo = todo[~hit]
            if not len(todo):
                return out
            context = self.index[k - 1].find(keys[k - 1][at[todo] - 1])
            known = context >= 0
            out[todo[known]] += self.log_left[k - 1][context[known]]
        out[todo] += self.log_p[0][0]
        return out


def _entropies(df: DataFrame, shared, kept: list[str]) -> DataFrame:
    """``kept`` with ``letters`` and ``entropies``, the cross-entropies of the text in the order of the languages."""
    schema = df.select(*kept).withColumns({"letters": F.lit(True), "entropies": F.array(F.lit(0.0))}).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        models, texts = shared.value, batch.column("text").to_pylist()
        letters, values, group = [], [], []

        def flush() -> None:
            if group:
                values.extend(models.entropies(group))
            group.clear()

        room = SLICE
        for t in texts:
            chars, has = characters(t or "")
            letters.append(has)
            group.append(chars)
            room -= len(chars)
            if room < 0:
                flush()
                room = SLICE
        flush()
        lists = pa.array([v.tolist() for v in values], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(letters), lists], [*kept, "letters", "entropies"])

    return df.mapInArrow(by_batch(run), schema)


def train(labelled: DataFrame, rows: int = SAMPLE_ROWS):
    """Fit models on rows ``(text, lang)``; returns their broadcast, the sharpness and the entropies of
    rejection. Rows with a null are left out. Without any row the models have no language."""
    spark = labelled.sparkSession
    sample = _sample(labelled.where("text IS NOT NULL AND lang IS NOT NULL"), rows).persist()
    models = Models(_counts(sample.where("NOT held")).toArrow())  # bounded by the sample
    shared = spark.sparkContext.broadcast(models)
    # The calibration rows: a fifth of the sample.
    held = [(r["lang"], r["entropies"]) for r in _entropies(sample.where("held"), shared, ["lang"]).where("letters").collect()]
    sample.unpersist()
    held = [(models.langs.index(lang), np.array(h)) for lang, h in held if lang in models.langs]
    sharpness, limits = 10.0, np.full(len(models.langs), np.inf)
    if held:
        truth, h = np.array([x for x, _ in held]), np.stack([x for _, x in held])
        gap = h - h.min(axis=1, keepdims=True)
        trials = np.geomspace(0.5, 64, 29)
        loss = [np.mean(t * gap[np.arange(len(h)), truth] + np.log(np.exp(-t * gap).sum(axis=1))) for t in trials]
        sharpness = float(trials[int(np.argmin(loss))])
        for i in range(len(limits)):
            own = h[truth == i, i]
            if len(own) >= 1 / REJECT_SHARE:
                limits[i] = np.quantile(own, 1 - REJECT_SHARE) + own.std()
            elif len(own):
                limits[i] = own.max() + 3 * own.std() + 0.5
    return shared, sharpness, limits


def identify(df: DataFrame, trained, kept: list[str], text: str = "text") -> DataFrame:
    """``kept`` columns of ``df`` with ``lang_pred``, ``score`` and ``rejected`` for every row.

    ``score`` is the calibrated probability of the language. ``rejected`` says that the text is
    unlike the language's own texts; the language is named all the same. A text that is null or
    has no letter is ``und`` with score 0 and rejected. So is every text without a language learned.
    """
    shared, sharpness, limits = trained
    langs = shared.value.langs
    if not langs:
        return df.select(*kept).selectExpr("*", f"'{UNDETERMINED}' AS lang_pred", "0D AS score", "true AS rejected")
    names = F.array(*[F.lit(x) for x in langs])
    bounds = F.array(*[F.lit(float(x)) for x in limits])
    rows = df.select(*kept, F.col(text).cast("string").alias("text")) if text not in kept else df.select(*kept)
    best = F.array_min("entropies")
    out = _entropies(rows, shared, kept).withColumn("best", best).withColumn("i", F.array_position("entropies", F.col("best")).cast("int"))
    odds = F.aggregate("entropies", F.lit(0.0), lambda acc, h: acc + F.exp(F.lit(-sharpness) * (h - F.col("best"))))
    return out.select(
        *kept,
        F.when(F.col("letters"), F.get(names, F.col("i") - 1)).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(F.col("letters"), 1 / odds).otherwise(F.lit(0.0)).alias("score"),
        (~F.col("letters") | (F.col("best") > F.get(bounds, F.col("i") - 1))).alias("rejected"),
    )


def predictions(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document ``(doc_id, held_out, lang_pred, score, rejected)``, learned from the documents not held out.

    A document is held out if crc32 of its id is 1 modulo 3; a null id isn't. Every row has an answer
    of its own, also where ids or whole rows repeat. Of languages that fit equally the first in code
    point order is named. Texts of any length are scored whole (a long text of the sample is cut at the
    part of its language); null and empty texts are ``und``, and an empty table gives no rows.
    """
    light = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    light = light.withColumn("held_out", F.expr("coalesce(crc32(CAST(doc_id AS string)) % 3 = 1, false)"))
    trained = train(light.where("NOT held_out").select("text", "lang"), rows)
    return identify(light.select("doc_id", "held_out", "text"), trained, ["doc_id", "held_out"])
