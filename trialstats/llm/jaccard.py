"""Near duplicates: n-gram Jaccard join by MinHash banding, verified on the full n-gram sets.

1. Every text gets the digest of its set of word n-grams and a MinHash signature, cut into
   bands; bands and rows are chosen for a target recall at the threshold.
2. Texts of one set are one class member from then on, so copies cost nothing further.
3. Band hashes are shuffled; in each bucket, members are tied to the least one. The connected
   components of these ties are the candidate groups.
4. Groups are cut into chunks, and each pair of chunks is verified in a task: the full sets of
   all texts are rebuilt and compared with one matrix product, no candidate pair is a row. A task
   returns a row per text: how many documents it is linked to, and the least text that it
   is connected with there.
5. Components of the verified ties are the classes.

A pair is lost only if it shares no band and no chain of bands; everything else is exact.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from trialstats.llm.common import as_bytes, by_batch, settle, text_key
from trialstats.llm.components import components
from trialstats.llm.hashes import mix

# Words in an n-gram, the least similarity, the recall wanted of a pair at it, and the longest signature.
WIDTH, THRESHOLD, RECALL, MOST_HASHES = 5, Fraction(4, 5), 0.9995, 256
# Texts in a chunk of a candidate group, and in a task that takes several small groups.
CHUNK, TASK_TEXTS = 256, 1024
# Columns of the membership matrix that are multiplied at once.
COLUMNS = 4096

_TURN = np.uint64(0x9E3779B97F4A7C15)


def banding(threshold: float = float(THRESHOLD), recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most rows, thus the fewest false candidates, with which a pair
    at the threshold shares a band with probability ``recall`` and the signature isn't too long."""
    best = (1, 1)
    for rows in range(1, most + 1):
        p = threshold**rows
        if p >= 1:
            return 1, most
        bands = int(np.ceil(np.log1p(-recall) / np.log1p(-p)))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The sorted set of hashes of the word n-grams; a shorter text is one n-gram of all its words."""
    words = text.split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(width, len(ids))
    h = np.full(len(ids) - n + 1, n, np.uint64)
    for k in range(n):
        h = mix(h * _TURN + ids[k:len(ids) - n + 1 + k])
    return np.unique(h)


def signature(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash per band of the MinHash signature."""
    rng = np.random.default_rng(8)
    factors = rng.integers(0, 2**32, bands * rows, dtype=np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
    short = (grams >> np.uint64(32)).astype(np.uint32)
    least = np.full(bands * rows, 2**32 - 1, np.uint32)
    for lo in range(0, len(short), 1 << 14):
        least = np.minimum(least, (factors[:, None] * short[None, lo:lo + (1 << 14)] + shifts[:, None]).min(axis=1))
    parts = least.reshape(bands, rows).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        h = mix(h * _TURN + parts[:, k])
    return h.view(np.int64)


def signed(df: DataFrame, doc_id: str, text: str, bands: int, rows: int, width: int) -> DataFrame:
    """``(doc_id, key, digest, bands)`` of every row; texts without words have no digest."""
    light = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    light = light.select("doc_id", text_key("text").alias("key"), "text")
    kind = light.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, lists = [], []
        for t in as_bytes(batch.column("text")):
            grams = shingles(t or b"", width)
            digests.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
            lists.append(signature(grams, bands, rows) if len(grams) else np.empty(0, np.int64))
        flat = pa.array(np.concatenate(lists))
        offsets = pa.array(np.cumsum([0, *map(len, lists)]).astype(np.int32))
        arrays = [batch.column("doc_id"), batch.column("key"), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(offsets, flat)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "key", "digest", "bands"])

    return light.mapInArrow(by_batch(run), f"doc_id {kind}, key binary, digest binary, bands array<bigint>")


def linked(sets: list[np.ndarray], threshold: Fraction) -> np.ndarray:
    """Which of the sets are similar: a symmetric matrix, false on the diagonal."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count[column] > 1
    number = np.cumsum(count > 1) - 1
    owner, column = owner[common], number[column[common]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((m, m), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (lo, lo + COLUMNS))
        members = np.zeros((m, COLUMNS), np.float32)
        members[owner[a:b], column[a:b] - lo] = 1
        shared += members @ members.T
    num, den = threshold.numerator, threshold.denominator
    similar = shared.astype(np.int64) * (num + den) >= num * (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(similar, False)
    return similar


def _least_connected(similar: np.ndarray) -> np.ndarray:
    """For every set the least one that it is connected with."""
    label = np.arange(len(similar))
    while True:
        lowest = np.where(similar, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, lowest)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verify(tasks: DataFrame, width: int, threshold: Fraction) -> DataFrame:
    """Rows ``(digest, links, root)`` of every text in every pair of chunks."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("component", "ascending"), ("digest", "ascending")])
        comps, digests = table["component"].to_pylist(), table["digest"].to_pylist()
        chunk, docs = table["chunk"].to_numpy(), table["n_docs"].to_numpy()
        texts = as_bytes(table["text"])
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        links, roots, start = [], [], 0
        while start < len(comps):
            end = start
            while end < len(comps) and comps[end] == comps[start]:
                end += 1
            similar = linked([shingles(t, width) for t in texts[start:end]], threshold)
            if lo != hi:  # pairs inside a chunk are the task of that chunk
                similar &= chunk[start:end, None] != chunk[None, start:end]
            links += (similar @ docs[start:end]).tolist()
            roots += [digests[start + i] for i in _least_connected(similar)]
            start = end
        return pa.table({"digest": table["digest"], "links": pa.array(links, pa.int64()), "root": pa.array(roots, pa.binary())})

    return tasks.groupBy("task", "lo", "hi").applyInArrow(run, "digest binary, links bigint, root binary")


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: Fraction = THRESHOLD, recall: float = RECALL,
    width: int = WIDTH, chunk: int = CHUNK,
) -> DataFrame:
    """Per row ``(doc_id, key, class_key, class_id, copy_id, n_links)``; ``key`` is ``text_key`` of its text.

    ``class_key`` tells the connected components of similar texts apart, also where ids are null or
    repeated: it is the least digest of the component. ``class_id`` is the least id of the
    component, ``copy_id`` the least id with the same n-gram set, both null only if all those ids
    are; ``n_links`` is the number of other rows whose set is similar, copies included. Words are
    told apart by case; a null text or one without words is alone in its class, which has no key,
    and has no links. A row of ``df`` gives a row, also when ids repeat.
    """
    bands, rows = banding(float(threshold), recall)
    sigs = settle(signed(df, doc_id, text, bands, rows, width))
    known = sigs.where("digest IS NOT NULL")
    members = known.groupBy("digest").agg(
        F.count("*").alias("n_docs"), F.min("doc_id").alias("copy_id"), F.min(F.struct("doc_id", "key")).alias("first")
    )
    distinct = known.select("digest", "bands").dropDuplicates(["digest"])
    buckets = distinct.select("digest", F.explode("bands").alias("bucket"))
    anchors = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min("digest").alias("anchor")).where("n > 1")
    ties = buckets.join(anchors, "bucket").selectExpr("digest AS a", "anchor AS b").where("a <> b").distinct()
    groups = settle(components(ties))

    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    grouped = (
        groups.join(sizes, "component").withColumnRenamed("node", "digest").join(members, "digest")
        .selectExpr("digest", "component", "n_docs", "first.doc_id AS f", "first.key AS k", f"CAST(ceil(size / {chunk}) AS int) AS chunks")
    )
    grouped = settle(grouped.selectExpr("*", "CAST(pmod(xxhash64(digest), chunks) AS int) AS chunk"))
    tasks = max(1, grouped.count() // TASK_TEXTS)
    texts = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    texts = texts.select("doc_id", text_key("text").alias("key"), "text")
    # One text per class member; both sides are dealt by key at every size, so the plan doesn't change with it.
    full = texts.join(grouped.hint("merge"), F.expr("doc_id <=> f AND key = k")).drop("doc_id", "key", "f", "k").dropDuplicates(["digest"])
    spread = full.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)"))).selectExpr(
        "digest", "component", "n_docs", "text", "chunk",
        f"IF(chunks = 1, pmod(xxhash64(component), {tasks}), xxhash64(component)) AS task",
        "IF(chunks = 1, -1, least(chunk, other)) AS lo", "IF(chunks = 1, -1, greatest(chunk, other)) AS hi",
    )
    verified = settle(_verify(spread, width, threshold))

    links = verified.groupBy("digest").agg(F.sum("links").alias("links"))
    classes = components(verified.selectExpr("digest AS a", "root AS b"))
    labelled = members.join(classes.withColumnRenamed("node", "digest"), "digest", "left").selectExpr(
        "digest", "n_docs", "copy_id", "coalesce(component, digest) AS component"
    )
    least = labelled.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    info = labelled.join(least, "component").join(links, "digest", "left").selectExpr(
        "digest AS d", "component AS class_key", "copy_id", "class_id", "n_docs - 1 + coalesce(links, 0) AS n_links"
    )
    # Written first: rows of a frequent set are then split by the join.
    return sigs.join(settle(info), F.expr("digest = d"), "left").selectExpr(
        "doc_id", "key", "class_key", "IF(d IS NULL, doc_id, class_id) AS class_id", "IF(d IS NULL, doc_id, copy_id) AS copy_id",
        "coalesce(n_links, 0) AS n_links",
    )


def one_per_class(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` without near duplicates: of each class the row with the least id stays, once.

    A row without an id stays only where its class has no id.
    Rows whose text is null or has no words all stay.
    """
    found = near_duplicates(df, doc_id, text, **options)
    packed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{doc_id}`").alias("id"),
        F.col(f"`{text}`").cast("string").alias("text"),
    ).withColumn("blank", F.expr(r"text IS NULL OR NOT regexp_like(text, r'[^\x20\x09-\x0D]')"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    first = found.where("class_key IS NOT NULL").groupBy("class_key").agg(F.min(order).alias("first"))
    mark = "md5(concat_ws('|', coalesce(CAST({} AS string), 'null'), hex({}))) AS mark"
    first = settle(first.selectExpr(mark.format("first.doc_id", "first.key")))
    keyed = packed.where("NOT blank").withColumn("key", text_key("text")).selectExpr("row", mark.format("id", "key"))
    # The join has dealt the rows by the key of the window; a repeated row is cut to one before it.
    chosen = keyed.join(first, "mark", "left_semi")
    once = chosen.withColumn("no", F.row_number().over(Window.partitionBy("mark").orderBy("mark"))).where("no = 1")
    return once.select("row.*").unionByName(packed.where("blank").select("row.*"))


def document_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its class by key (hexadecimal) and least id, the least copy of it and the number of its links."""
    return near_duplicates(df, doc_id, text).drop("key").withColumn("class_key", F.lower(F.hex("class_key")))
