"""Shards of near equal bytes by k-d tree partitioning.

Points are the groups of equal texts, weighted by their bytes; a group too large for one
point is dealt into pieces by document. The tree splits a node along its widest metadata
dimension at the weighted median, where ties go by a hash, until each leaf is a shard. All
nodes of a level are split together: their medians are found digit by digit from histograms
that are summed in Spark, so what reaches the driver is a bounded number of bins, never points.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialstats.llm.common import settle

# Fixed value: the law that holds for the shards.
LAW = "bytes"
# A group of equal texts above 1/64 of a shard is dealt into pieces of that size.
PIECES = 64
# Bins of all nodes of a level in one histogram, as a power of two, and the most of one node.
BINS, NODE_BINS = 18, 14
# A cut may miss its weight by this share of the node.
SLACK = 1 / 8192
# Rows of a shard that are numbered in one task.
SLOT_ROWS = 50_000
# Bits of the hash that settles ties.
TIE_BITS = 62
# Of these, the first that tell labels apart whose first seven bytes are alike.
LABEL_BITS = 24


def _code(name: str) -> str:
    """The first seven bytes of a string as a number in the same order; null comes first."""
    head = f"rpad(hex(substring(encode({name}, 'UTF-8'), 1, 7)), 14, '0')"
    return f"coalesce(CAST(conv({head}, 16, 10) AS bigint) + 1, 0)"


def _points(rows: DataFrame, total: int, leaves: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their ``piece``, and one weighted point per piece of a group.

    Pieces are dealt by the id; copies under one id (or none) that are too large for a piece are dealt
    by the number of their row. Labels that begin alike are kept apart by the first bits of the tie.
    """
    limit = max(1, total // (leaves * PIECES))
    # Groups above the limit: at most PIECES per shard, as their bytes add up to the total.
    giant = rows.groupBy("key").agg(F.sum("size").alias("b")).where(F.col("b") > limit)
    giant = settle(giant.selectExpr("key AS giant", f"CAST(ceil(b / {limit}) AS int) AS pieces"))
    giants = rows.join(F.broadcast(giant), F.expr("key = giant"), "left")
    # Ids above the limit: bounded like the giants.
    alike = giants.where("pieces IS NOT NULL").groupBy("key", "doc_id").agg(F.sum("size").alias("b")).where(F.col("b") > limit)
    alike = settle(alike.selectExpr("struct(key, doc_id) AS hot"))
    dealt = giants.withColumn("own", F.expr("struct(key, doc_id)")).join(F.broadcast(alike), F.expr("own = hot"), "left").selectExpr(
        *rows.columns, "coalesce(CAST(pmod(IF(hot IS NULL, xxhash64(doc_id), xxhash64(row)), pieces) AS int), 0) AS piece"
    )
    points = dealt.groupBy("key", "piece").agg(
        F.sum("size").alias("bytes"), F.max("size").alias("d0"), F.min("source").alias("source"), F.min("lang").alias("lang"),
    )
    tie = f"shiftrightunsigned(xxhash64(key, piece), {64 - TIE_BITS})"

    def after(label: str) -> str:
        return f"(shiftrightunsigned(xxhash64({label}), {64 - LABEL_BITS}) << {TIE_BITS - LABEL_BITS}) + shiftright({tie}, {LABEL_BITS})"

    return dealt, settle(points.selectExpr(
        "key", "piece", "bytes", "d0", f"{_code('source')} AS d1", f"{_code('lang')} AS d2",
        f"{tie} AS t0", f"{after('source')} AS t1", f"{after('lang')} AS t2",
    ))


def _widths(row, spans: list[tuple[float, float]]) -> list[float]:
    """Widths of a node along the dimensions, relative to those of all points; sizes by their logarithm."""
    import math

    out = []
    for d, (lo, hi) in enumerate(spans):
        scale = math.log2 if d == 0 else float
        whole = scale(hi + 1) - scale(lo + 1)
        out.append((scale(row[f"hi{d}"] + 1) - scale(row[f"lo{d}"] + 1)) / whole if whole else 0.0)
    return out


class _Cut:
    """Search of one node's cut: a prefix of (coordinate, tie) in digits, and the weight below it."""

    def __init__(self, node: int, dim: int, low: int, high: int, weight: int, share: float):
        self.node, self.dim, self.low = node, dim, low
        self.bits = (high - low).bit_length()
        self.left = self.bits + TIE_BITS
        self.weight, self.goal, self.below, self.prefix, self.done = weight, weight * share, 0, 0, False

    def step(self, bits: int) -> int:
        """Bits of the next digit: digits don't straddle the two components."""
        end = TIE_BITS if self.left > TIE_BITS else 0
        return min(bits, self.left - end)

    def take(self, bins: dict[int, int], digit_bits: int) -> None:
        """Descend into the bin where the goal lies, or stop at its edge if that is near enough."""
        self.left -= digit_bits
        for digit in sorted(bins):
            if self.below + bins[digit] > self.goal or digit == max(bins):
                above = self.below + bins[digit]
                near_low, near_high = self.goal - self.below, abs(above - self.goal)
                at_end = not self.left
                if min(near_low, near_high) <= self.weight * SLACK or at_end:
                    # Neither side stays empty if there is something for both.
                    into = near_high < near_low if 0 < self.below and above < self.weight else above < self.weight
                    self.prefix = (self.prefix << digit_bits) + digit + into
                    self.done = True
                else:
                    self.prefix = (self.prefix << digit_bits) + digit
                return
            self.below += bins[digit]

    def bound(self) -> tuple[int, int]:
        """The cut as (coordinate, tie): what is smaller goes left."""
        value = self.prefix << self.left
        return self.low + (value >> TIE_BITS), value & ((1 << TIE_BITS) - 1)


_AT = "CASE dim WHEN 0 THEN d0 WHEN 1 THEN d1 ELSE d2 END"
_TIE = "CASE dim WHEN 0 THEN t0 WHEN 1 THEN t1 ELSE t2 END"


def _search(points: DataFrame, cuts: list[_Cut]) -> None:
    """Find the cuts of all nodes of a level."""
    spark = points.sparkSession
    while open_cuts := [c for c in cuts if not c.done]:
        bits = max(2, min(NODE_BINS, BINS - len(open_cuts).bit_length()))
        digits = {c.node: c.step(bits) for c in open_cuts}
        params = []
        for c in open_cuts:
            in_tie = c.left <= TIE_BITS
            b = digits[c.node]
            shift = c.left - b - (0 if in_tie else TIE_BITS)
            known = c.prefix if not in_tie else c.prefix >> (TIE_BITS - c.left)
            tie_known = c.prefix & ((1 << (TIE_BITS - c.left)) - 1) if in_tie else 0
            # Bits of the coordinate and of the tie above the digit, with the values they must have.
            params.append((c.node, c.dim, c.low, 0 if in_tie else shift + b, known, in_tie, shift, tie_known, (1 << b) - 1))
        names = "node int, dim int, low bigint, above int, known bigint, in_tie boolean, shift int, tie_known bigint, mask bigint"
        asked = F.broadcast(spark.createDataFrame(params, names))  # one row per node
        at = f"({_AT} - low)"
        fits = f"shiftright({at}, above) = known AND (NOT in_tie OR shiftright({_TIE}, shift) div (mask + 1) = tie_known)"
        digit = f"shiftright(IF(in_tie, {_TIE}, {at}), shift) & mask"
        bins = points.join(asked, "node").where(fits).selectExpr("node", f"{digit} AS digit", "bytes")
        found: dict[int, dict[int, int]] = defaultdict(dict)
        for r in bins.groupBy("node", "digit").agg(F.sum("bytes").alias("b")).collect():  # at most 2^BINS rows
            found[r["node"]][r["digit"]] = r["b"]
        for c in open_cuts:
            c.take(found[c.node], digits[c.node])


def kd_leaves(points: DataFrame, leaves: int) -> DataFrame:
    """``points`` with ``node``, the number of their leaf from 0, for ``leaves`` leaves of near equal weight."""
    spark = points.sparkSession
    points = points.withColumn("node", F.lit(0))
    sizes = {0: leaves}
    ends = [e for d in range(3) for e in (F.min(f"d{d}").alias(f"lo{d}"), F.max(f"d{d}").alias(f"hi{d}"))]
    spans = None
    while True:
        # One row per node that has points; the leaves of a node without any stay empty.
        nodes = {r["node"]: r for r in points.groupBy("node").agg(F.sum("bytes").alias("bytes"), *ends).collect()}
        if all(sizes[node] == 1 for node in nodes):
            return points
        spans = spans or [(nodes[0][f"lo{d}"], nodes[0][f"hi{d}"]) for d in range(3)]
        cuts = []
        for node, row in nodes.items():
            if sizes[node] > 1:
                widths = _widths(row, spans)
                dim = widths.index(max(widths)) if max(widths) > 0 else 1  # labels may still differ behind their first bytes
                share = sizes[node] // 2 / sizes[node]
                cuts.append(_Cut(node, dim, row[f"lo{dim}"], row[f"hi{dim}"], row["bytes"], share))
        _search(points, cuts)
        # Nodes are numbered by their first leaf, so a left child keeps its number.
        table = [(c.node, c.dim, *c.bound(), c.node + sizes[c.node] // 2) for c in cuts]
        bounds = F.broadcast(spark.createDataFrame(table, "node int, dim int, c bigint, t bigint, right int"))
        goes_left = f"dim IS NULL OR {_AT} < c OR ({_AT} = c AND {_TIE} < t)"
        points = settle(points.join(bounds, "node", "left").selectExpr(
            *[x for x in points.columns if x != "node"], f"IF({goes_left}, node, right) AS node"
        ))
        for c in cuts:
            n = sizes[c.node]
            sizes[c.node], sizes[c.node + n // 2] = n // 2, n - n // 2


def shards(
    df: DataFrame,
    count: int | None = None,
    target_bytes: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """Per row ``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``.

    ``count`` shards, or as many as ``target_bytes`` asks for. A size is the UTF-8 bytes of the
    text (null: none) plus 1. Equal texts share a shard unless their group is dealt in pieces
    or shares a cut. Every row has a place: null texts are a group, repeated rows are rows, texts of
    any length are points of their size. With fewer points than shards some shards stay empty, and
    an empty table gives no rows.
    """
    value = F.col(f"`{text}`").cast("string")
    light = settle(df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.coalesce(F.octet_length(value), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(value), F.lit(0)).alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(value)), F.unhex(F.lit("00"))).alias("key"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{lang}`").cast("string").alias("lang"),
    ))
    total, n_rows = light.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    leaves = count or max(1, -(-total // target_bytes))
    dealt, points = _points(light, total, leaves)
    placed = kd_leaves(points, leaves).select("key", "piece", F.col("node").alias("shard"))
    parts = max(1, n_rows // (leaves * slot_rows))
    rows = settle(dealt.join(placed, ["key", "piece"]).selectExpr(
        "doc_id", "size", "text_crc32", "shard", f"pmod(xxhash64(doc_id, key), {parts}) AS part"
    ))
    # A row per part of a shard; only those are ordered together.
    offsets = rows.groupBy("shard", "part").agg(F.count("*").alias("n")).selectExpr(
        "shard", "part", "sum(n) OVER (PARTITION BY shard ORDER BY part) - n AS before"
    )
    number = "row_number() OVER (PARTITION BY shard, part ORDER BY doc_id, text_crc32, size)"
    return rows.selectExpr("*", f"{number} AS no").join(offsets, ["shard", "part"]).selectExpr(
        "doc_id", "size", "text_crc32", f"'{LAW}' AS law", "shard", "before + no - 1 AS slot", "CAST(NULL AS int) AS grown_shard"
    )
