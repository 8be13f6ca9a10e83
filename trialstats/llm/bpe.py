"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes cuts a text wherever the last 32 bytes say so, so a passage is
cut alike in every document that holds it. Then

1. texts are brought together by their hash, which leaves one copy of each text;
2. the hashes of all chunks are counted, and of every chunk that occurs more than once one
   occurrence is its owner: only there it is encoded;
3. the encoded chunks go back to all texts that refer to them; a text encodes the rest itself;
4. joins of chunks are repaired: around a join that is no token boundary for sure, the text
   between the nearest sure boundaries is encoded again, wider as long as the tokens on either
   side don't end exactly there.

A sure boundary is a space after a visible character: the tokenizer's word pattern begins a
word there whatever stands around it. Chunk texts are read from the one shuffle of the texts;
otherwise only hashes and the ids of shared chunks move.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialstats.llm.common import as_bytes, by_batch, settle, text_key

# Fixed value: the word pattern of byte-level BPE.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A space after one of these characters begins a word whatever surrounds it.
SURE_BOUNDARY = re.compile(r"(?<=[!-~À-ɏ]) ")
# Pieces kept with their ids by an encoder, and the longest one that is kept.
CACHE_PIECES, CACHE_LENGTH = 200_000, 48
# A chunk ends where this many bits of the rolling hash are zero: 1 KiB on average.
CHUNK_BITS = 10
# A cut moves on to a sure boundary when one is this near.
SNAP = 64

_GEAR = np.random.default_rng(20).integers(0, 2**32, 256, dtype=np.uint32)
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Pieces(dict):
    """Ids of text pieces; encodes what it doesn't hold, and starts anew when full."""

    def __init__(self, encode, prefix: str):
        super().__init__()
        self.encode, self.prefix = encode, prefix

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(self.prefix + piece)
        if len(piece) <= CACHE_LENGTH:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder of one vocabulary file in the format of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = _byte_of()
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in specials}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
        order = [vocab["".join(pair)] for pair in pairs]
        if order != sorted(order):
            raise ValueError(f"{path}: the ids don't follow the order of the merges")
        self._bpe = tiktoken.Encoding("bytes", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._specials = specials
        self._split = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True)) or r"(?!)")
        size = max([*ranks.values(), *specials.values()]) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.names = np.array([str(i) for i in range(size)], object)
        self.table = np.array([b""] * size, object)
        for token, i in [*ranks.items(), *((s.encode(), i) for s, i in specials.items())]:
            self.table[i] = token
        self.lengths = np.array([len(t) for t in self.table], np.int64)
        self._spaced = _Pieces(self._whole, " ")

    def _whole(self, text: str) -> bytes:
        """Ids of a text, as bytes of ``dtype``; the strings of special tokens become their ids."""
        ids, at = [], 0
        for m in self._split.finditer(text):
            ids += self._bpe.encode_ordinary(text[at:m.start()])
            ids.append(self._specials[m[0]])
            at = m.end()
        ids += self._bpe.encode_ordinary(text[at:] if at else text)
        return np.array(ids, self.dtype).tobytes()

    def encode(self, text: str) -> np.ndarray:
        first, *rest = SURE_BOUNDARY.split(text)
        return np.frombuffer(self._whole(first) + b"".join(map(self._spaced.__getitem__, rest)), self.dtype)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(self.table[ids].tolist())

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a file, loaded once in a worker."""
    return Codec(path)


def _sure(data: np.ndarray) -> np.ndarray:
    """Offsets of sure boundaries inside a text."""
    return np.flatnonzero((data[1:] == 0x20) & _VISIBLE[data[:-1]]) + 1


def chunk_bounds(text: bytes, bits: int = CHUNK_BITS) -> np.ndarray:
    """Offsets where chunks begin and end, from 0 to the length: they follow from the bytes nearby alone."""
    data = np.frombuffer(text, np.uint8)
    if len(data) < 33:
        return np.array([0, len(data)])
    h = _GEAR[data]
    for shift in (1, 2, 4, 8, 16):
        h[shift:] += h[:-shift] << np.uint32(shift)
    cuts = np.flatnonzero(h[31:] >> np.uint32(32 - bits) == 0) + 32
    sure = np.append(_sure(data), len(data))
    snapped = sure[np.searchsorted(sure, cuts)]
    starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    cuts = np.where(snapped - cuts <= SNAP, snapped, starts[np.searchsorted(starts, cuts)])
    return np.unique(np.concatenate(([0], cuts, [len(data)])))


def join_chunks(text: bytes, bounds: list[int], chunks: list[np.ndarray], codec: Codec) -> np.ndarray:
    """Ids of a text from the ids of its chunks, with the joins repaired."""
    if len(chunks) == 1:
        return chunks[0]
    data = np.frombuffer(text, np.uint8)
    inner = np.array(bounds[1:-1])
    unsafe = inner[~((data[inner] == 0x20) & _VISIBLE[data[inner - 1]])]
    if not len(unsafe):
        return np.concatenate(chunks)
    ids = np.concatenate(chunks)
    ends = np.cumsum(codec.lengths[ids])  # the chunks' own tokens tile the text
    sure = np.concatenate(([0], _sure(data), [len(data)]))
    inside = ~np.isin(sure, inner)
    agreed = sure[(inside & np.isin(sure, ends)) | (sure == 0) | (sure == len(data)) | ~inside]
    left = np.searchsorted(agreed, unsafe) - 1
    out, at, k = [], 0, 0
    while k < len(unsafe):
        lo, hi = agreed[left[k]], agreed[left[k] + 1]
        while k < len(unsafe) and unsafe[k] < hi:
            k += 1
        out.append(ids[np.searchsorted(ends, at, "right"):np.searchsorted(ends, lo, "right")])
        out.append(codec.encode(text[lo:hi].decode("utf-8")))
        at = hi
    out.append(ids[np.searchsorted(ends, at, "right"):])
    return np.concatenate(out)


def distinct_texts(df: DataFrame, text: str) -> DataFrame:
    """One row ``(key, text)`` per different text; null counts as empty. Copies are combined before the shuffle."""
    rows = df.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.select(text_key("text").alias("key"), "text").dropDuplicates(["key"])


def _references(texts: DataFrame, bits: int) -> DataFrame:
    """A row ``(hash, key, pos)`` for every chunk of every text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, keys, places = [], [], []
        for key, text in zip(batch.column("key").to_pylist(), as_bytes(batch.column("text")), strict=True):
            bounds = chunk_bounds(text, bits).tolist()
            for pos, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
                hashes.append(hashlib.blake2b(text[lo:hi], digest_size=16).digest())
                keys.append(key)
                places.append(pos)
        arrays = [pa.array(hashes, pa.binary()), pa.array(keys, pa.binary()), pa.array(places, pa.int32())]
        return pa.RecordBatch.from_arrays(arrays, ["hash", "key", "pos"])

    return texts.mapInArrow(by_batch(run), "hash binary, key binary, pos int")


def _owned(owners: DataFrame, path: str, bits: int) -> DataFrame:
    """Encode the chunks that a text owns: rows ``(hash, ids)``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c, hashes, ids = codec(path), [], []
        for text, owned in zip(as_bytes(batch.column("text")), batch.column("owned").to_pylist(), strict=True):
            bounds = chunk_bounds(text, bits)
            for o in owned:
                hashes.append(o["hash"])
                ids.append(c.encode(text[bounds[o["pos"]]:bounds[o["pos"] + 1]].decode("utf-8")).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), pa.array(ids, pa.binary())], ["hash", "ids"])

    return owners.mapInArrow(by_batch(run), "hash binary, ids binary")


def _assembled(parts: DataFrame, path: str, bits: int) -> DataFrame:
    """Encode what is left of a text, put the given chunks in and repair the joins."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c, out = codec(path), []
        for text, given in zip(as_bytes(batch.column("text")), batch.column("given").to_pylist(), strict=True):
            if not given:
                out.append(c.encode(text.decode("utf-8")))
                continue
            shared = {g["pos"]: np.frombuffer(g["ids"], c.dtype) for g in given}
            bounds = chunk_bounds(text, bits).tolist()
            edges, chunks, own = [0], [], 0
            for pos in range(len(bounds) - 1):
                if pos in shared:
                    if own < bounds[pos]:
                        chunks.append(c.encode(text[own:bounds[pos]].decode("utf-8")))
                        edges.append(bounds[pos])
                    chunks.append(shared[pos])
                    edges.append(bounds[pos + 1])
                    own = bounds[pos + 1]
            if own < len(text):
                chunks.append(c.encode(text[own:].decode("utf-8")))
                edges.append(len(text))
            out.append(join_chunks(text, edges, chunks, c))
        flat = pa.array(np.concatenate(out).astype(np.int32))
        offsets = pa.array(np.cumsum([0, *map(len, out)]).astype(np.int32))
        return pa.RecordBatch.from_arrays([batch.column("key"), pa.ListArray.from_arrays(offsets, flat)], ["key", "ids"])

    return parts.mapInArrow(by_batch(run), "key binary, ids array<int>")


def encode_texts(df: DataFrame, path: str, text: str = "text", bits: int = CHUNK_BITS) -> DataFrame:
    """Token ids of every different text of ``df``: rows ``(key, ids)`` with ``key`` as in ``text_key``.

    The ids are those that the tokenizers library gives with the file at ``path`` and without
    added special tokens. A null text counts as empty and an empty one has no ids; equal texts
    share a row; an empty table gives none. ``path`` must exist on every worker.
    """
    texts = distinct_texts(df, text)
    refs = settle(_references(texts, bits))
    shared = refs.groupBy("hash").agg(F.count("*").alias("n"), F.min(F.struct("key", "pos")).alias("first"))
    owners = (
        shared.where("n > 1")
        .select("first.key", F.struct("hash", "first.pos").alias("chunk"))
        .groupBy("key").agg(F.collect_list("chunk").alias("owned"))  # a text's own chunks
    )
    encoded = settle(_owned(texts.join(owners, "key"), path, bits))
    given = (
        refs.join(encoded, "hash")
        .select("key", F.struct("pos", "ids").alias("chunk"))
        .groupBy("key").agg(F.collect_list("chunk").alias("given"))
    )
    return _assembled(texts.join(given, "key", "left"), path, bits)


def encode(df: DataFrame, path: str, text: str = "text", bits: int = CHUNK_BITS) -> DataFrame:
    """``df`` with the column ``ids``, one row for each of its rows (a column of that name is replaced)."""
    encoded = encode_texts(df, path, text, bits).select(F.col("key").alias("__key"), F.col("ids").alias("__ids"))
    kept = [F.col(f"`{c}`") for c in df.columns if c != "ids"]
    keyed = df.withColumn("__key", text_key(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return keyed.join(encoded, "__key").select(*kept, F.col("__ids").alias("ids"))


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in ``out``; special tokens stay, null ids give null, bytes
    that are no UTF-8 become replacement characters."""
    kept = [c for c in encoded.columns if c != out]
    schema = encoded.select(*[f"`{c}`" for c in kept]).withColumn(out, F.lit("")).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path)
        texts = [None if x is None else c.decode(np.array(x, np.int64)) for x in batch.column(ids).to_pylist()]
        arrays = [*[batch.column(k) for k in kept], pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, [*kept, out])

    return encoded.mapInArrow(by_batch(run), schema)


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256)`` of encoded texts: the form in which runs are compared."""

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c, column = codec(path), batch.column("ids")
        flat, offsets = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
        n, ids_sha, text_sha = [], [], []
        for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
            ids = flat[lo:hi]
            n.append(len(ids))
            ids_sha.append(sha(",".join(c.names[ids].tolist()).encode()))
            text_sha.append(sha(c.decode(ids).encode()))
        arrays = [batch.column("key"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
        return pa.RecordBatch.from_arrays(arrays, ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(by_batch(run), "key binary, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def document_digests(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, number of tokens, digest of the ids and digest of the decoded text.

    A row of ``df`` gives a row, also when its id is null or repeated; a null text counts as empty.
    """
    rows = df.select(F.col(doc_id).alias("doc_id"), text_key(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("key"))
    return rows.join(digests(encode_texts(df, path, text), path), "key").drop("key")
