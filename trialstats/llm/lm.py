"""Scores under an interpolated modified Kneser-Ney model of words, counted and asked in Spark.

Neither the texts nor the model fit one machine, so both are cut: documents into blocks, and
the n-grams of each order into shards, which are ranges of their 64-bit hashes. A block is stored as
the numbers of its words and the sorted hashes that they stand for, so texts are read and cut into words
once. For each order, from the longest down,

1. a block sends every shard its distinct n-grams in that range, sorted, with what it knows of
   them: occurrences in training documents for the longest, and for a shorter one the
   longer types that it owns (how many words precede it, and what it is as a context);
2. a shard merges what the blocks sent into its sorted hash array, memory-mapped in the worker,
   with the summed counts, and answers each block for its own n-grams; of a type that
   several blocks hold, the first one becomes the owner;
3. finally a block has, for each of its n-grams, the counts, the context sums and the
   discounts of every order, and adds up the probabilities of its documents.

Blocks and shards grow in number with the text, and a row goes from one to another only where there
are n-grams. The totals of an order are summed once. A frequent n-gram is one entry per block, and
a long text is cut nowhere. The answers of an order are written to the shared folder, which
survives lost executors, and what was shuffled for them can go.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh3_64_intdigest
from zstandard import ZstdCompressor, ZstdDecompressor

from trialstats.llm.common import as_bytes, by_batch, settle
from trialstats.llm.hashes import discounts, mapped, mix, pack, unpack

# Words in an n-gram, and the bytes of text in a block (and of n-grams in a shard, about).
ORDER, BLOCK_BYTES = 3, 5_000_000
# Held-out documents: crc32 of the id is 1 modulo this.
FOLDS = 5

# Tokens that no word hashes to by intent: the end of a text, and what stands before its first word.
_END, _START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_TURN = np.uint64(0x165667B19E3779F9)
# What is summed per n-gram: continuations, then as a context the types counted once, twice and more, and
# what the total has above 1, 2 and 3 for each of these, which is mostly zero.
_FIELDS = ["count", "rest", "once", "twice", "more"]
# Statistics of a shard: types with counts 1 to 4, then the sum of counts and, of words, training tokens and types.
_STATS = 7

_BLOCK = "block int, docs binary, lengths binary, vocabulary binary, words binary"
_ASKED = "shard int, block int, keys binary, values binary"
_ANSWER = "block int, shard int, level int, values binary, stats array<double>"
# The block number of a row that holds the statistics of a shard.
_TOTALS = -1


def tokens(text: bytes) -> np.ndarray:
    """Hashes of the lower-case words of a text and its end."""
    words = text.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    out[-1] = _END
    return out


def _stored(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The row of a block: its documents in a fixed order, and their words as numbers of a vocabulary."""
    table = table.sort_by([("mark", "ascending"), ("doc_id", "ascending")])
    plain = ZstdDecompressor()
    parts = [tokens(plain.decompress(t) if t else b"") for t in table["text"].to_pylist()]
    vocabulary, words = np.unique(np.concatenate(parts), return_inverse=True)
    docs = table.select(["doc_id", "held_out"]).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as writer:
        writer.write_table(docs)
    row = {
        "block": key[0].as_py(), "docs": ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes()),
        "lengths": pack(np.array([len(p) for p in parts], np.int32)),
        "vocabulary": pack(vocabulary, sort_gaps=True), "words": pack(words.astype(np.uint32)),
    }
    return pa.table({k: pa.array([v], pa.int32() if k == "block" else pa.binary()) for k, v in row.items()})


class Block:
    """The n-grams of the documents of a block: for each order their hashes by place."""

    def __init__(self, row: dict, order: int):
        self.table, self.order = pa.ipc.open_stream(ZstdDecompressor().decompress(row["docs"])).read_all(), order
        self.lengths = unpack(row["lengths"], "<i4").astype(np.int64)
        ends = np.cumsum(self.lengths + order - 1)
        first = np.cumsum(self.lengths) - self.lengths
        self.owner = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        self.places = np.arange(self.lengths.sum()) + (ends - self.lengths - first)[self.owner]
        words = np.full(ends[-1], _START)
        words[self.places] = unpack(row["vocabulary"], "<u8", sort_gaps=True)[unpack(row["words"], "<u4")]
        training = ~np.array(self.table["held_out"].to_pylist(), bool)
        self.training = training[self.owner]
        # keys[m][i]: the m words that end at place i; the context of an (m+1)-gram ends one place before.
        self.keys = [np.zeros(len(words), np.uint64), words]
        for m in range(2, order + 1):
            longer = self.keys[m - 1].copy()
            longer[1:] = mix(mix(self.keys[m - 1][:-1]) * _TURN + words[1:])
            self.keys.append(longer)

    def types(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """The sorted distinct m-grams of a block and, for every place, which of them ends there.

        Shorter ones than the longest are wanted as contexts as well, so those before each text count.
        """
        keys = self.keys[m] if m < self.order else self.keys[m][self.places]
        found, rank = np.unique(keys, return_inverse=True)
        if m < self.order:
            return found, rank
        number = np.full(len(self.keys[m]), -1)
        number[self.places] = rank
        return found, number


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the ranges of the shards begin and end in sorted keys."""
    edges = np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


def _send(block: int, keys: np.ndarray, values: np.ndarray, shards: int) -> pa.Table:
    """A row for every shard that there are n-grams for."""
    cuts = _cuts(keys, shards)
    pairs = [(s, a, b) for s, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if a < b]
    return pa.table({
        "shard": pa.array([s for s, _, _ in pairs], pa.int32()),
        "block": pa.array([block] * len(pairs), pa.int32()),
        "keys": pa.array([pack(keys[a:b], sort_gaps=True) for _, a, b in pairs], pa.binary()),
        "values": pa.array([pack(np.ascontiguousarray(values[:, a:b]).reshape(-1)) for _, a, b in pairs], pa.binary()),
    })


def _merge(level: int, order: int):
    """The work of a shard: sum what the blocks sent for a type, find its owner, answer."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        blocks = table["block"].to_pylist()
        keys = [unpack(k, "<u8", sort_gaps=True) for k in table["keys"].to_pylist()]
        values = [unpack(v, "<u8").reshape(-1, len(k)) for v, k in zip(table["values"].to_pylist(), keys, strict=True)]
        types = mapped(np.unique(np.concatenate(keys)))
        width = 1 if level == order else len(_FIELDS) + (level == 1)
        sums = np.zeros((width, len(types)), np.uint64)
        owner = np.full(len(types), -1, np.int32)
        at = []
        for k, v in zip(keys, values, strict=True):
            place = np.searchsorted(types, k)  # both are sorted, so this walks through memory
            at.append(place)
            sums[:, place] += v  # the keys of a block are distinct
            first = place[(owner[place] < 0) & (v[0] > 0)]
            owner[first] = len(at) - 1
        counts = sums[0]
        stats = np.zeros(_STATS)
        stats[:4] = [(counts == c).sum() for c in (1, 2, 3, 4)]
        stats[4] = counts.sum()
        if level == 1:
            stats[5], stats[6] = sums[-1].sum(), (sums[-1] > 0).sum()
        answers = []
        for number, place in enumerate(at):
            got = sums[:, place]
            own = (owner[place] == number).astype(np.uint64)
            answers.append(pack(np.concatenate([got, own[None]]).astype(np.uint64).reshape(-1)))
        shard, n = table["shard"][0].as_py(), len(blocks)
        return pa.table({
            "block": pa.array([*blocks, _TOTALS], pa.int32()), "shard": pa.array([shard] * (n + 1), pa.int32()),
            "level": pa.array([level] * (n + 1), pa.int32()), "values": pa.array([*answers, None], pa.binary()),
            "stats": pa.array([*[None] * n, stats.tolist()], pa.list_(pa.float64())),
        })

    return run


def _answers(table: pa.Table, level: int, asked: np.ndarray, shards: int) -> np.ndarray:
    """The values of the asked n-grams of an order, from the rows of all shards."""
    cuts = _cuts(asked, shards)
    parts = {r["shard"]: r["values"] for r in table.to_pylist() if r["level"] == level}
    return np.concatenate([unpack(v, "<u8").reshape(-1, int(cuts[s + 1] - cuts[s])) for s, v in sorted(parts.items())], axis=1)


def _ask_longest(order: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Block(row, order)
                keys, number = block.types(order)
                seen = np.bincount(number[block.places[block.training]], minlength=len(keys)).astype(np.uint64)
                yield from _send(row["block"], keys, seen[None], shards).to_batches()

    return run


def _ask_shorter(level: int, order: int, shards: int):
    """Ask for the n-grams of an order, with what the owned types of the next longer order add to them."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _send(0, np.zeros(0, np.uint64), np.zeros((1, 0), np.uint64), shards)
        block = Block(table.to_pylist()[0], order)
        longer, number = block.types(level + 1)
        got = _answers(answers, level + 1, longer, shards)
        # A place where each owned type ends gives its suffix, and the place before its context.
        ends = np.zeros(len(longer), np.int64)
        ends[number[block.places]] = block.places
        owned = got[-1] > 0
        ends, count = ends[owned], got[0][owned].astype(np.int64)
        del longer, number, got
        asked, number = block.types(level)
        suffix, context = number[ends], number[ends - 1]
        values = np.zeros((len(_FIELDS) + (level == 1), len(asked)), np.int64)
        values[0] += np.bincount(suffix, minlength=len(asked))
        values[1] += np.bincount(context, weights=count, minlength=len(asked)).astype(np.int64)
        for row, kind in ((2, count == 1), (3, count == 2), (4, count > 2)):
            values[row] += np.bincount(context[kind], minlength=len(asked))
        values[1] -= values[2] + 2 * values[3] + 3 * values[4]
        if level == 1:  # occurrences of words, for the unigram baseline
            values[-1] += np.bincount(number[block.places[block.training]], minlength=len(asked))
        return _send(key[0].as_py(), asked, values.astype(np.uint64), shards)

    return run


def _score(order: int, shards: int, totals: dict[int, np.ndarray], schema: pa.Schema):
    """``totals`` holds the summed statistics of each order."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        block = Block(table.to_pylist()[0], order)
        p = None
        for level in range(1, order + 1):
            asked, number = block.types(level)
            got, stats = _answers(answers, level, asked, shards), totals[level]
            place = number[block.places]
            d = discounts(stats[:4])
            count = got[0][place].astype(np.float64)
            off = np.maximum(count - d[np.minimum(count, 3).astype(np.int64)], 0)
            if level == 1:
                raw, n, types = got[-2][place].astype(np.float64), stats[5], stats[6]
                base = np.log10((raw + 0.5) / (n + 0.5 * (types + 1)))
                known = raw > 0
                total, kinds = stats[4], np.array([stats[0], stats[1], 0.0])
                kinds[2] = _types(stats) - kinds[0] - kinds[1]
                p = (off + d[1:] @ kinds / (types + 1)) / total if total else np.full(len(place), 1.0 / (types + 1))
            else:
                seen = total_of > 0
                share = np.where(seen, off / np.where(seen, total_of, 1), 0)
                p = np.where(seen, share + left * p, p)
            if level < order:  # as contexts of the next order
                at = number[block.places - 1]
                _, rest, once, twice, more = (got[i][at].astype(np.float64) for i in range(len(_FIELDS)))
                total_of = rest + once + 2 * twice + 3 * more
                e = discounts(totals[level + 1][:4])
                left = np.where(total_of > 0, (e[1] * once + e[2] * twice + e[3] * more) / np.where(total_of > 0, total_of, 1), 1)
        docs = len(block.lengths)

        def total(values: np.ndarray) -> np.ndarray:
            return np.bincount(block.owner, weights=values, minlength=docs)

        rows = block.table
        return pa.table({
            "doc_id": rows["doc_id"], "held_out": rows["held_out"],
            "n_tokens": pa.array(block.lengths.astype(np.int64)), "n_known": pa.array(total(known).astype(np.int64)),
            "train_tokens": pa.array(np.full(docs, int(n), np.int64)),
            "base_score": pa.array(total(base)), "score": pa.array(total(np.log10(p))),
        })

    return run


def _types(stats: np.ndarray) -> float:
    """Types of the lowest order with a continuation: every training word, as each has something before it."""
    return stats[6]


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with each text compressed, so that less is shuffled and held."""
    schema = docs.withColumn("text", F.col("text").cast("binary")).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        small = ZstdCompressor(level=3)
        texts = pa.array([small.compress(t) if t else None for t in as_bytes(batch.column("text"))], pa.binary())
        return pa.RecordBatch.from_arrays([texts if n == "text" else batch.column(n) for n in batch.schema.names], batch.schema.names)

    return docs.mapInArrow(by_batch(run), schema)


def scores(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES, folds: int = FOLDS
) -> DataFrame:
    """Per document ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``.

    The model learns from the documents not held out; a null id is not held out. A null or empty
    text is its end alone. Without training documents every token has probability 1. Equal rows
    are rows. ``perplexity`` of a document is ``10 ** (-score / n_tokens)``.
    """
    if order < 2:
        raise ValueError("the order is 2 or more")
    held = f"coalesce(crc32(CAST(`{doc_id}` AS string)) % {folds} = 1, false)"
    size = df.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0)), F.count("*")).first()
    blocks = max(1, -(-(size[0] + size[1]) // block_bytes))
    docs = df.selectExpr(
        f"`{doc_id}` AS doc_id", f"CAST(`{text}` AS string) AS text", f"{held} AS held_out",
        f"xxhash64(`{doc_id}`, `{text}`) AS mark",
    ).selectExpr("*", f"CAST(pmod(mark, {blocks}) AS int) AS block")
    stored = settle(_packed(docs).groupBy("block").applyInArrow(_stored, _BLOCK))
    shards = blocks
    totals, answered = {}, None
    for level in range(order, 0, -1):
        _release(df.sparkSession)
        if answered is None:
            asked = stored.mapInArrow(_ask_longest(order, shards), _ASKED)
        else:
            before = answered.where(f"level = {level + 1}")
            asked = stored.groupBy("block").cogroup(before.groupBy("block")).applyInArrow(_ask_shorter(level, order, shards), _ASKED)
        merged = settle(asked.groupBy("shard").applyInArrow(_merge(level, order), _ANSWER))
        sums = [F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(_STATS)]
        # One row of a few numbers.
        totals[level] = np.array([x or 0.0 for x in merged.where(f"block = {_TOTALS}").agg(*sums).first()])
        answers = merged.where(f"block <> {_TOTALS}").drop("stats")
        answered = answers if answered is None else answered.unionByName(answers)
        del asked
    _release(df.sparkSession)
    out = f"doc_id {df.schema[doc_id].dataType.simpleString()}, " + (
        "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
    empty = to_arrow_schema(T.StructType.fromDDL(out))
    return stored.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(_score(order, shards, totals, empty), out)


def _release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that are done: it does so when their objects are collected."""
    gc.collect()
    spark._jvm.System.gc()


def perplexities(scored: DataFrame) -> DataFrame:
    """``scored`` with ``perplexity`` per token."""
    return scored.withColumn("perplexity", F.expr("power(10D, -score / n_tokens)"))
