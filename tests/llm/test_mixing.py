"""Targets against plain water filling; words taken against targets; expectations of the rounding."""

import numpy as np
import pytest

from trialstats.llm import catalog, mixing

SCHEMA = "doc_id bigint, text string, source string"


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3 * sizes[s]
            free.discard(s)
    return target


def rows(spark, counts, seed=1):
    rng = np.random.default_rng(seed)
    data = []
    for source, n in counts.items():
        for k in range(n):
            words = int(rng.integers(0, 60))
            data.append((len(data), " \t".join(["wörd"] * words) if k % 17 else None, source))
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("part_docs,fan", [(4000, 1024), (7, 2)])
def test_targets_and_words_taken(spark, part_docs, fan):
    counts = {"b": 300, "a": 20, "z": 900, "é": 60, "tiny": 1, None: 150, "\U0001F600": 40}
    df = rows(spark, counts).selectExpr("*", "1 AS row", "2 AS size", "3 AS share", "4 AS tie")
    out = mixing.mix(df, part_docs=part_docs, fan=fan).collect()
    assert len(out) == sum(counts.values())
    sizes = {s: 0 for s in counts}
    taken = {s: 0 for s in counts}
    largest = {s: 0 for s in counts}
    for r in out:
        assert r.size == len((r.row.text or "").split()) and 0 <= r.copies <= 3
        sizes[r.row.source] += r.size
        taken[r.row.source] += r.size * r.copies
        largest[r.row.source] = max(largest[r.row.source], r.size)
    want = plain_targets(sizes)
    for r in out:
        assert r.source_size == sizes[r.row.source] and r.target == pytest.approx(want[r.row.source])
    for s in counts:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6, s
    again = mixing.mix(df.repartition(5), part_docs=part_docs, fan=fan).collect()
    assert sorted((r.row.doc_id, r.copies) for r in again) == sorted((r.row.doc_id, r.copies) for r in out)


def test_rounding_keeps_expectations():
    rng = np.random.default_rng(3)
    sizes, shares = np.array([5, 1, 9, 0, 3, 3]), np.array([0.3, 0.7, 0.5, 0.4, 1.0, 0.2])
    total = np.zeros(6)
    for _ in range(20000):
        p, held = mixing.pivotal(sizes, shares, rng)
        if held >= 0:
            assert abs((p * sizes)[[0, 1, 2, 4, 5]].sum() - (sizes * shares)[[0, 1, 2, 4, 5]].sum()) < 1e-9
            p[held] = rng.random() < p[held]
        assert set(p) <= {0.0, 1.0}
        total += p
    assert np.abs(total / 20000 - shares).max() < 0.02


def test_reserve_keeps_expectations_and_words():
    rng = np.random.default_rng(5)
    sizes = np.array([40, 30, 22, 9, 8, 8, 5, 3, 2, 1])
    wanted = np.array([0.3, 1.7, 0.5, 1.4, 1.0, 2.2, 1.5, 0.6, 1.5, 1.5])
    total = np.zeros(len(sizes))
    for _ in range(20000):
        copies = mixing.settle_reserve(sizes, wanted, 3, rng)
        assert set(copies) <= {0.0, 1.0, 2.0, 3.0} and abs((copies - wanted) @ sizes) <= 2
        total += copies
    missed = np.abs(total / 20000 - wanted)
    assert missed[:-3].max() < 0.03 and missed.max() < 0.15  # the last ones have little room to pass words on to
    # One document that the others can't make up for: the nearer end.
    assert mixing.settle_reserve(np.array([100, 1]), np.array([0.4, 0.4]), 3, rng)[0] == 0


def test_every_source_is_near_its_target(spark):
    docs = {d.doc_id: d.source for d in catalog.documents(spark, "/root/testdata/sf0.01").collect()}
    taken, target = {}, {}
    for r in catalog.op9_mixing(spark, "/root/testdata/sf0.01").collect():
        taken[docs[r.doc_id]] = taken.get(docs[r.doc_id], 0) + r.taken
        target[docs[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in target)


@pytest.mark.parametrize("part_docs,fan,reserve", [(7, 2, 5), (50, 1024, 20)])
def test_rounds_before_the_reserve(spark, part_docs, fan, reserve):
    df = rows(spark, {"a": 900, "b": 400, "c": 60})
    out = mixing.mix(df, part_docs=part_docs, fan=fan, reserve=reserve).collect()
    for s in "abc":
        own = [r for r in out if r.row.source == s]
        assert abs(sum(r.size * r.copies for r in own) - own[0].target) <= 60 and max(r.copies for r in own) <= 3


def test_whole_table_and_edges(spark):
    out = catalog.op9_mixing(spark, "/root/testdata/sf0.01").collect()
    docs = catalog.documents(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in out) == sorted(d.doc_id for d in docs)
    by_source = {d.doc_id: d.source for d in docs}
    taken, target, size = {}, {}, {}
    for r in out:
        s = by_source[r.doc_id]
        taken[s], target[s], size[s] = taken.get(s, 0) + r.taken, r.target, r.source_size
    want = plain_targets(size)
    for s in target:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) < 0.12 * target[s]
    assert mixing.mix(rows(spark, {"a": 1}).limit(0)).count() == 0
    nothing = spark.createDataFrame([(None, None, None), (1, "", "x"), (1, "", "x")], SCHEMA)
    assert [r.target for r in mixing.mix(nothing).collect()] == [0.0] * 3


def test_rows_are_repeated(spark):
    df = spark.createDataFrame([(1, "a b c d", "s"), (1, "a b c d", "s"), (2, "x " * 80, "t")], SCHEMA)
    mixed = mixing.mixed_rows(df)
    assert mixed.columns == df.columns
    copies = {r.row.doc_id: r.copies for r in mixing.mix(df).where("size > 50").collect()}
    assert mixed.where("doc_id = 2").count() == copies[2]
