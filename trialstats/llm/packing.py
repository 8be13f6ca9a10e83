"""Packing of encoded documents into sequences of a fixed length by harmonic classes.

A piece of ``l`` tokens belongs to the class ``j = capacity // l``: it lies in
``(capacity / (j + 1), capacity / j]``, and a sequence of the class takes exactly ``j`` pieces.
Sequences are thus filled by counting alone: every worker numbers the pieces of its part of a
class, and number ``i`` goes to sequence ``i // j`` of the class. Where a piece would leave
too much of its place empty, its document is cut: a piece that fills a place of the next class
exactly is taken off, and the rest is looked at again. The last sequence of a class, which may
be short, is undone, and those few pieces (a number set by the capacity alone) are packed
by first-fit decreasing.

Only lengths and check sums move between workers; the ids stay where they are made unless they are
asked for.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialstats.llm.bpe import codec
from trialstats.llm.common import by_batch, settle

# Tokens of a sequence, and the id that ends a document.
CAPACITY, END_ID = 2048, 1
# A piece may leave this share of its place empty before its document is cut.
SLACK = 1 / 64
# Pieces that are numbered in one task.
PART_PIECES = 100_000
# Words kept with their ids by an encoder, and the longest one that is kept, in characters.
CACHE_WORDS, CACHE_LENGTH = 400_000, 40

# Characters besides space and line end that texts of the quick way may have.
_PLAIN = frozenset(map(chr, [*range(0x21, 0x7F), *range(0xC0, 0x250)]))


class WordEncoder:
    """Ids of many texts at a time: words are encoded together, each different one once.

    A space or line end between two visible characters begins a word of the tokenizer whatever
    else stands around it, so the ids of a text are those of its words in a row. Texts with other
    white space or characters go through the codec as a whole.
    """

    def __init__(self, path: str):
        self.codec = codec(path)
        self.known: dict[str, bytes] = {}

    def _quick(self, text: str) -> bool:
        if text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return False
        return set(text) <= _PLAIN | {" ", "\n"} and not self.codec._split.search(text)

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, from one call of the encoder: each stands behind a space, or behind its own line end."""
        parts = [w if w[0] == "\n" else " " + w for w in words]
        ids = np.array(self.codec._bpe.encode_ordinary("".join(parts)), self.codec.dtype)
        ends = np.cumsum(self.codec.lengths[ids])
        cuts = np.searchsorted(ends, np.cumsum([len(p.encode()) for p in parts])) + 1
        data, width = ids.tobytes(), self.codec.dtype.itemsize
        edges = [0, *(cuts * width).tolist()]
        return {w: data[a:b] for w, a, b in zip(words, edges, edges[1:], strict=False)}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        quick = [bool(t) and self._quick(t) for t in texts]
        # The first word has no space before it and is encoded with what it stands for at the codec.
        split = [t.replace("\n", " \n").split(" ") if q else [] for t, q in zip(texts, quick, strict=True)]
        new = set().union(*(w[1:] for w in split)).difference(self.known)
        long = {w for w in new if len(w) > CACHE_LENGTH}
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = set().union(*(w[1:] for w in split))
        found = self._learn(list(new)) if new else {}
        self.known.update(found)
        out = []
        for text, is_quick, words in zip(texts, quick, split, strict=True):
            if is_quick:
                first = self.codec._whole(words[0])
                out.append(np.frombuffer(first + b"".join(map(self.known.__getitem__, words[1:])), self.codec.dtype))
            else:
                out.append(self.codec.encode(text))
        for w in long:
            self.known.pop(w, None)
        return out


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a file, made once in a worker."""
    return WordEncoder(path)


def cut_lengths(n: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens: full sequences, then places of ever higher classes."""
    out = [capacity] * (n // capacity)
    left = n % capacity
    while left:
        per = capacity // left
        place = capacity // per
        smaller = capacity // (per + 1)
        if place - left <= slack * place or not smaller:
            out.append(left)
            break
        out.append(smaller)
        left -= smaller
    return out


def encoded_pieces(
    df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, slack: float = SLACK, with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: ``(doc_id, start, length, ids_crc32, doc_tokens)``, and ``ids`` if asked for.

    A document is the ids of its text and ``end_id``; a null text is empty.
    """
    schema = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * with_ids
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = word_encoder(path)
        row, start, length, crc, total, pieces = [], [], [], [], [], []
        texts = batch.column("text").to_pylist()
        for lo in range(0, len(texts), 256):
            for i, ids in enumerate(encoder.encode(texts[lo:lo + 256]), lo):
                data = np.append(ids, end_id).astype("<u4")
                at = 0
                for n in cut_lengths(len(data), capacity, slack):
                    piece = data[at:at + n]
                    row.append(i)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(piece))
                    total.append(len(data))
                    if with_ids:
                        pieces.append(piece.astype(np.int32))
                    at += n
        arrays = [batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:
            offsets = pa.array(np.cumsum([0, *length]).astype(np.int32))
            arrays.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(pieces))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(by_batch(run), f"doc_id {kind}, {schema}")


def _first_fit(pieces: pa.Table, capacity: int) -> pa.Table:
    """Sequences of pieces by first-fit decreasing: ``bin`` from 0, and ``offset`` in it."""
    order = np.lexsort((pieces["no"].to_numpy(), -pieces["length"].to_numpy()))
    used, bins, offsets = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    for i in order:
        n = pieces["length"][int(i)].as_py()
        at = int(np.argmax(used + n <= capacity))
        bins[i], offsets[i] = at, used[at]
        used[at] += n
    return pieces.append_column("bin", pa.array(bins)).append_column("offset", pa.array(offsets))


def place(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES) -> DataFrame:
    """``pieces`` (any rows with a ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    No sequence holds more than ``capacity``; numbers of sequences go from 0 without gaps, offsets
    follow one another. All but a few sequences, whose number depends on the capacity alone, hold
    the full number of pieces of their class.
    """
    others = [F.col(f"`{c}`") for c in pieces.columns if c not in ("sequence_id", "offset")]
    # Written once with a number of their own, so that equal rows are spread and a task that runs again finds the same.
    rows = settle(pieces.select(
        F.struct(*others).alias("row"), F.expr(f"{capacity} div length AS class"), F.col("length").cast("bigint").alias("length"),
        F.monotonically_increasing_id().alias("id"),
    ))
    parts = settle(rows.groupBy("class").agg(F.count("*").alias("n")).selectExpr(  # a row per class, at most 2 * sqrt(capacity)
        "class", "n div class AS full", f"CAST(ceil(n / {part_pieces}) AS bigint) AS parts",
        "coalesce(sum(n div class) OVER (ORDER BY class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base",
        "sum(n div class) OVER () AS all_full",
    ))
    dealt = rows.join(F.broadcast(parts), "class").withColumn("part", F.expr("pmod(xxhash64(id), parts)"))
    before = dealt.groupBy("class", "part").agg(F.count("*").alias("m")).selectExpr(
        "class", "part", "sum(m) OVER (PARTITION BY class ORDER BY part) - m AS before"
    )
    number = "row_number() OVER (PARTITION BY class, part ORDER BY id) - 1"
    numbered = settle(dealt.withColumn("k", F.expr(number)).join(before, ["class", "part"]).selectExpr(
        "row", "class", "length", "full", "base", "all_full", "before + k AS no"
    ))
    whole = numbered.where("no < full * class").selectExpr("row", "length", "base + no div class AS sequence_id", "no % class AS k")
    offset = "CAST(sum(length) OVER (PARTITION BY sequence_id ORDER BY k) - length AS bigint) AS offset"
    whole = whole.selectExpr("row", "sequence_id", offset)
    # Fewer than ``class`` pieces of each class, whatever the input.
    short = numbered.where("no >= full * class").selectExpr("class", "no", "length", "all_full")
    schema = "class bigint, no bigint, length bigint, all_full bigint, bin bigint, offset bigint"

    def fit(table: pa.Table) -> pa.Table:
        return _first_fit(table.select(["class", "no", "length", "all_full"]), capacity)

    fitted = short.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(fit, schema)
    fitted = settle(fitted).selectExpr("class", "no", "all_full + bin AS sequence_id", "offset")
    rest = numbered.where("no >= full * class").select("row", "class", "no").join(F.broadcast(fitted), ["class", "no"])
    return whole.unionByName(rest.select("row", "sequence_id", "offset")).select("row.*", "sequence_id", "offset")


def sequences(placed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, ids, doc_ids)`` from placed pieces with their ids: ids padded to ``capacity``, and
    the document of each piece in order. A sequence whose tokens are a power of two stays as it is."""
    rows = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"))
    flat = rows.selectExpr("sequence_id", "flatten(transform(p, x -> x.ids)) AS ids", "transform(p, x -> x.doc_id) AS doc_ids")
    padding = f"IF(bit_count(size(ids)) = 1, 0, {capacity} - size(ids))"
    return flat.selectExpr("sequence_id", f"concat(ids, array_repeat({pad_id}, {padding})) AS ids", "doc_ids")


def pieces(
    df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, slack: float = SLACK, with_ids: bool = False, part_pieces: int = PART_PIECES,
) -> DataFrame:
    """All documents packed: per piece ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    Every id of a document (those of its text, then ``end_id``) lies in exactly one piece; ``start``
    counts the ids before it, ``ids_crc32`` is of its ids as little-endian 32-bit numbers. A null or
    empty text is a document of one id; long texts are cut into many sequences; repeated rows
    and null ids are documents of their own; other columns play no part; an empty table gives no rows.
    Lengths of pieces depend on the document alone, their places also on the order of the rows.
    """
    made = encoded_pieces(df, path, doc_id, text, capacity, end_id, slack, with_ids)
    return place(made, capacity, part_pieces)
