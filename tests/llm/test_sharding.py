"""Shards: near equal bytes, gapless slots, and the same place for equal texts."""

import zlib
from collections import defaultdict

import numpy as np

from trialstats.llm import catalog, sharding

SCHEMA = "doc_id bigint, text string, source string, lang string"


def check(out, n_rows, shards, slack):
    assert len(out) == n_rows
    size, slots = defaultdict(int), defaultdict(list)
    for r in out:
        assert r.law == "bytes" and r.grown_shard is None
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(size) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size.values()) / shards
    assert all(abs(size[k] - mean) <= slack for k in range(shards)), dict(size)


def test_whole_table(spark):
    docs = {d.doc_id: d.text for d in catalog.documents(spark, "/root/testdata/sf0.1").collect()}
    out = catalog.op5_sharding(spark, "/root/testdata/sf0.1").collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    for r in out:
        data = docs[r.doc_id].encode()
        assert r.size == len(data) + 1 and r.text_crc32 == zlib.crc32(data)
    check(out, len(docs), 8, 0.01 * sum(r.size for r in out) / 8)
    places = defaultdict(set)
    for r in out:
        places[r.text_crc32].add(r.shard)
    assert sum(len(p) > 1 for p in places.values()) <= 8


def test_hot_group_is_dealt(spark):
    rng = np.random.default_rng(2)
    data = [(i, "copy " * 20, "hot", "en") for i in range(3000)]
    data += [(9000 + i, "w" * int(rng.integers(1, 300)), f"s{i % 7}", None) for i in range(2000)] + [(None, None, None, None)] * 3
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 AS key", "2 AS piece", "3 AS node", "4 AS d0")
    out = sharding.shards(df, count=8).collect()
    check(out, len(data), 8, 0.06 * sum(r.size for r in out) / 8)
    again = sharding.shards(df.repartition(7), count=8, slot_rows=50).collect()
    check(again, len(data), 8, 0.06 * sum(r.size for r in out) / 8)
    assert sorted((r.doc_id, r.shard) for r in again if r.doc_id) == sorted((r.doc_id, r.shard) for r in out if r.doc_id)


def test_target_bytes_and_edges(spark):
    data = [(i, "x" * 99, "same", "same") for i in range(640)]
    df = spark.createDataFrame(data, SCHEMA)
    out = sharding.shards(df, target_bytes=6400).collect()
    check(out, 640, 10, 0.25 * 6400)
    assert sharding.shards(df.limit(0), count=8).count() == 0
    assert [r.size for r in sharding.shards(spark.createDataFrame([(1, None, None, None)], SCHEMA), count=8).collect()] == [1]
    two = spark.createDataFrame([(i, f"{i}" * 50, "a", "b") for i in range(64)], SCHEMA)
    check(sharding.shards(two, count=8).collect(), 64, 8, 120)


def test_few_points_and_lopsided_tables(spark):
    for n in (1, 3, 7):
        out = sharding.shards(spark.createDataFrame([(i, "x" * (i + 1), "a", "b") for i in range(n)], SCHEMA), count=8).collect()
        check(out, n, 8, 10)
        assert len({r.shard for r in out}) >= n - 1
    data = [(i, "y" * (1 + i % 50), f"s{i % 3}", "en") for i in range(500)] + [(None, "null id " * 4, None, None)] * 3000
    data += [(7, "one id " * 4, "s", "en")] * 2000
    df = spark.createDataFrame(data, SCHEMA)
    out = sharding.shards(df, count=8).collect()
    check(out, len(data), 8, 0.06 * sum(r.size for r in out) / 8)


def plain_cut(points, leaves):
    """A plain k-d tree over (coordinates, weight): shards by sorting every node whole."""
    if leaves == 1 or not points:
        return [points] + [[]] * (leaves - 1)
    spans = [max(p[d] for p in points) - min(p[d] for p in points) for d in range(2)]
    dim = spans.index(max(spans))
    points = sorted(points, key=lambda p: p[dim])
    goal, below, cut = sum(p[-1] for p in points) * (leaves // 2) / leaves, 0, 0
    while below + points[cut][-1] / 2 <= goal:
        below += points[cut][-1]
        cut += 1
    return plain_cut(points[:cut], leaves // 2) + plain_cut(points[cut:], leaves - leaves // 2)


def test_tree_equals_a_plain_one(spark):
    """One dimension varies, no ties, weights alike: the cuts are those of a sorted list."""
    rng = np.random.default_rng(8)
    values = sorted(set(rng.integers(0, 10**9, 800).tolist()))[:640]
    rows = [(i, 0, 10, 5, v, 0, i, i, i) for i, v in enumerate(values)]
    names = "key int, piece int, bytes bigint, d0 bigint, d1 bigint, d2 bigint, t0 bigint, t1 bigint, t2 bigint"
    out = sharding.kd_leaves(spark.createDataFrame(rows, names), 8).collect()
    want = plain_cut([(v, 0, 10) for v in values], 8)
    assert {r.d1: r.node for r in out} == {p[0]: k for k, leaf in enumerate(want) for p in leaf}


def test_labels_alike_in_seven_bytes_stay_together(spark):
    data = [(i, "z" * 40 + f"{i:03}", f"www.example.org/{'ab'[i % 2]}", "en") for i in range(400)]
    out = sharding.shards(spark.createDataFrame(data, SCHEMA), count=2).collect()
    check(out, 400, 2, 400)
    assert len({(r.shard, r.doc_id % 2) for r in out}) <= 3


def test_very_long_and_repeated_rows(spark):
    data = [(i, "w" * 1000, "s", "en") for i in range(4000)] + [(9000, "long " * 200_000, "s", "en")] + [(9001, "twice " * 300, None, None)] * 2
    out = sharding.shards(spark.createDataFrame(data, SCHEMA), count=4).collect()
    check(out, len(data), 4, 0.06 * sum(r.size for r in out) / 4)
    assert max(r.size for r in out) == 1_000_001 and sum(r.doc_id == 9001 for r in out) == 2
