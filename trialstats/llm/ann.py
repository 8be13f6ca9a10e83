"""Nearest neighbours by inner product with randomly rotated one-bit codes.

Vectors are centred, rotated at random and reduced to the signs of their coordinates, packed
into bits, with two correction scalars each. The bits give an unbiased estimate of every inner
product and a bound of its error. In a block of vectors the best estimates are computed exactly
first; then every vector whose estimate plus error bound reaches the k-th of those is computed
as well, so the codes only decide what is left out. Queries are quantised to eight bits a coordinate, so
that an estimate is a sum of population counts over packed words; what that rounds is part of the bound.
All rows are indexed. Each block of vectors meets each block of queries in a task, both of bounded
size; a block keeps its k nearest per query, and the lists are merged by a limited window, which
Spark cuts before the shuffle.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trialstats.llm.common import settle

# Vectors in a block of the index at most, and in the small blocks that keep all cores busy; queries in a block.
BLOCK_VECTORS, SMALL_BLOCK, BLOCK_QUERIES = 65536, 4096, 8192
# Bits of a quantised coordinate of a query.
QUERY_BITS = 8
# Error bounds are this many times the expected size of an error.
EPSILON = 3.0
# Estimates that are computed exactly at first, in multiples of k.
FIRST = 4
# About so many vectors fix the centre; it affects the tightness of the codes only.
CENTRE_SAMPLE = 4096
SEED = 6


@lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    """The random rotation for vectors of a length."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dims]).standard_normal((dims, dims)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs of the rotated vectors, their distance from the centre, and how well the signs fit."""
    dims = vectors.shape[1]
    residual = vectors - centre
    norm = np.linalg.norm(residual, axis=1)
    unit = residual / np.where(norm > 0, norm, 1)[:, None]
    turned = unit.astype(np.float32) @ rotation(dims).T
    fit = np.abs(turned).sum(axis=1) / np.sqrt(dims)
    return np.packbits(turned >= 0, axis=1), norm, np.where(norm > 0, fit, 1.0)


def _words(packed: np.ndarray) -> np.ndarray:
    """Packed bits of each row as 64-bit words."""
    out = np.zeros((len(packed), -(-packed.shape[1] // 8) * 8), np.uint8)
    out[:, :packed.shape[1]] = packed
    return out.view(np.uint64)


def estimates(codes: np.ndarray, norm: np.ndarray, fit: np.ndarray, centre: np.ndarray, queries: np.ndarray):
    """Estimated inner products (vectors by queries) and the bounds of their errors, from the packed codes."""
    dims = queries.shape[1]
    words = _words(codes)
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    scale = norm / (fit * np.sqrt(dims))
    middle = np.empty((len(codes), len(queries)), np.float32)
    rounded = np.empty(len(queries))
    for j, turned in enumerate(queries @ rotation(dims).T.astype(np.float64)):
        low = turned.min()
        step = (turned.max() - low) / (2**QUERY_BITS - 1) or 1.0
        level = np.rint((turned - low) / step).astype(np.uint64)
        planes = _words(np.packbits(level[None, :] >> np.arange(QUERY_BITS, dtype=np.uint64)[:, None] & np.uint64(1) > 0, axis=1))
        total = np.zeros(len(codes), np.int64)
        for k, plane in enumerate(planes):
            for w in range(words.shape[1]):
                total += np.bitwise_count(words[:, w] & plane[w]).astype(np.int64) << k
        # Coordinates with a set bit count once, those without against them.
        middle[:, j] = scale * (2 * (low * ones + step * total) - turned.sum()) + queries[j] @ centre
        rounded[j] = dims * step / 2
    if dims < 2:
        return middle, np.full_like(middle, np.inf)
    spread = norm * np.sqrt(np.maximum(1 - fit**2, 0)) / fit * EPSILON / np.sqrt(dims - 1)
    return middle, (np.outer(spread, np.linalg.norm(queries, axis=1)) + np.outer(scale, rounded)).astype(np.float32)


def nearest(index: dict, rows: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the places and exact inner products of its k nearest vectors of a block, nearest first.

    ``rows`` are the numbers of the queries' own rows, which are no candidates.
    """
    out = []
    for lo in range(0, len(rows), 64):
        part = queries[lo:lo + 64]
        middle, bound = estimates(index["codes"], index["norm"], index["fit"], index["centre"], part)
        for j, query in enumerate(part):
            usable = index["rows"] != rows[lo + j]
            est = np.where(usable, middle[:, j], -np.inf)
            n = min(FIRST * k, len(est))
            first = np.argpartition(-est, n - 1)[:n]
            exact = index["vectors"][first] @ query
            exact = exact[usable[first]]
            reach = np.partition(exact, -k)[-k] if len(exact) >= k else -np.inf
            asked = np.flatnonzero(usable & (middle[:, j] + bound[:, j] >= reach - 1e-6 * abs(reach) - 1e-6))
            asked = np.union1d(asked, first[usable[first]])
            score = (index["vectors"][asked] * query).sum(axis=1)
            best = np.lexsort((index["ids"][asked], -score))[:k]
            out.append((asked[best], score[best]))
    return out


def usable_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, v, row)`` of the rows that take part: no null, empty, zero or non-finite vector, no null id."""
    rows = df.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"), F.monotonically_increasing_id().alias("row")
    )
    finite = "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    return rows.where(f"vec_id IS NOT NULL AND size(v) > 0 AND {finite} AND exists(v, x -> x <> 0)")


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, dims)


def build_index(rows: DataFrame, blocks: int) -> DataFrame:
    """The index: a row per block with ids, rows, codes, correction scalars and vectors."""
    total = rows.count()
    draw = f"pmod(xxhash64(vec_id, {SEED}), 1000000) < 1000000D * {CENTRE_SAMPLE} / {max(1, total)}"
    sums = (
        rows.where(draw).selectExpr("size(v) AS dims", "posexplode(v) AS (i, x)")
        .groupBy("dims", "i").agg(F.avg("x").alias("x"))
        .groupBy("dims").agg(F.expr("transform(array_sort(collect_list(struct(i, x))), s -> s.x) AS centre"))
    )
    centres = {r["dims"]: r["centre"] for r in sums.collect()}  # one row per vector length

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dims, block = key[0].as_py(), key[1].as_py()
        table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        vectors, ids, own = _matrix(table["v"], dims), table["vec_id"].to_numpy(), table["row"].to_numpy()
        centre = np.array(centres.get(dims) or np.zeros(dims))
        codes, norm, fit = encode(vectors, centre)
        blobs = [x.tobytes() for x in (ids.astype(np.int64), own, codes, norm, fit, centre, vectors)]
        return pa.table({"dims": [dims], "block": [block]} | dict(zip(_BLOBS, ([b] for b in blobs), strict=True)))

    keyed = rows.selectExpr("CAST(size(v) AS bigint) AS dims", f"pmod(xxhash64(row), {blocks}) AS block", "vec_id", "v", "row")
    return keyed.groupBy("dims", "block").applyInArrow(run, "dims bigint, block bigint, " + ", ".join(f"{b} binary" for b in _BLOBS))


_BLOBS = ["ids", "rows", "codes", "norm", "fit", "centre", "vectors"]


def search(
    df: DataFrame, is_query: str, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
    block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The k nearest other vectors of every query: ``(query_id, rank, vec_id, score)``.

    ``is_query`` is an expression over ``vec_id``. Nearest first, ties to the smaller id; fewer
    than k where there are fewer. Rows that share an id are different vectors: each is a candidate of
    the others, and each that is a query has answers of its own. Vectors of different lengths don't
    meet. An empty table, or one without queries, gives no rows.
    """
    rows = settle(usable_vectors(df, vec_id, vector))
    total, n_queries = rows.agg(F.count("*"), F.count_if(F.expr(is_query))).first()
    cores = 2 * df.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-total // block_vectors), min(cores, total // min(block_vectors, SMALL_BLOCK)))
    parts = max(1, -(-n_queries // block_queries))
    index = build_index(rows, blocks)

    def packed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dims = key[0].as_py()
        return pa.table({
            "dims": [dims], "part": [key[1].as_py()], "q_ids": [table["vec_id"].to_numpy().astype(np.int64).tobytes()],
            "q_rows": [table["row"].to_numpy().tobytes()], "q_vectors": [np.ascontiguousarray(_matrix(table["v"], dims)).tobytes()],
        })

    asked = rows.where(is_query).selectExpr("CAST(size(v) AS bigint) AS dims", f"pmod(xxhash64(row), {parts}) AS part", "vec_id", "v", "row")
    queries = asked.groupBy("dims", "part").applyInArrow(packed, "dims bigint, part bigint, q_ids binary, q_rows binary, q_vectors binary")
    schema = "query_id bigint, query_row bigint, ids array<bigint>, scores array<double>"

    def run(key: tuple[pa.Scalar, ...], held: pa.Table, wanted: pa.Table) -> pa.Table:
        found: list[list] = [[], [], [], []]
        dims = key[0].as_py()
        if held.num_rows and wanted.num_rows:
            r = held.to_pylist()[0] | wanted.to_pylist()[0]
            part = {
                "ids": np.frombuffer(r["ids"], np.int64), "rows": np.frombuffer(r["rows"], np.int64), "norm": np.frombuffer(r["norm"]), "fit": np.frombuffer(r["fit"]),
                "centre": np.frombuffer(r["centre"]), "vectors": np.frombuffer(r["vectors"]).reshape(-1, dims),
                "codes": np.frombuffer(r["codes"], np.uint8).reshape(-1, -(-dims // 8)),
            }
            ids, own = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["q_rows"], np.int64)
            vectors = np.frombuffer(r["q_vectors"]).reshape(-1, dims)
            for q, row, (places, scores) in zip(ids, own, nearest(part, own, vectors, k), strict=True):
                found[0].append(int(q))
                found[1].append(int(row))
                found[2].append(part["ids"][places].tolist())
                found[3].append(scores.tolist())
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
        names = ["query_id", "query_row", "ids", "scores"]
        return pa.table({n: pa.array(x, k) for n, x, k in zip(names, found, kinds, strict=True)})

    # Every block of queries goes to every block of vectors: one of each in a task.
    cell = ["dims", "block", "part"]
    index = index.withColumn("part", F.explode(F.expr(f"sequence(0L, {parts - 1}L)")))
    spread = queries.withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    lists = index.groupBy(*cell).cogroup(spread.groupBy(*cell)).applyInArrow(run, schema)
    flat = lists.select("query_id", "query_row", F.inline(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score"))))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
